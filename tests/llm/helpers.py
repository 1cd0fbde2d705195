"""Edge frames and plain brute-force versions shared by the tests of the llm operators."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid string, k int, size string, node string, spans string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def edge_rows():
    """Null ids and texts, empty and very long texts, repeated rows, ties, clashing column names."""
    para = " ".join(f"w{i % 97}x{i % 13}" for i in range(120))
    long = " ".join(f"t{i * 7919 % 10007}" for i in range(30_000))
    texts = {
        1: para, 2: para, 3: para + " tail one", 4: None, 5: "", 6: " \n\t ", 7: "one two three", 8: "ONE two three",
        9: long, 10: "a " * 300, 11: "é ü 中文 words here", 12: para.replace("w5x5", "other"), 13: "x" * 50_000,
        14: "mail a.b@c.example.com or +1 (542) 555-3599 now", 15: "line\n" * 80,
    }
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 5 else None, len(t or ""), "u", 1, "z", "n", "p") for i, t in texts.items()]
    rows += [rows[0], rows[0], rows[8]]  # repeated rows
    rows += [(None, para, "fr", "s1", 3, "u", 1, "z", "n", "p"), (None, None, None, None, None, None, None, None, None, None)]
    return rows


def edge_frame(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def empty_frame(spark):
    return spark.createDataFrame([], SCHEMA)
