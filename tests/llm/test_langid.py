import zlib

from tests.llm.helpers import edge_frame, edge_rows, empty_frame
from vantage.llm import langid as L


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    got = L.identify_language(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_lang_of_held_out_rows_is_never_read(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    key = lambda df: sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in df.collect())
    changed = docs.selectExpr("doc_id", "text", "source", "if(crc32(cast(doc_id as string)) % 4 = 2, 'xx', lang) as lang")
    assert key(L.identify_language(docs)) == key(L.identify_language(changed.repartition(3)))


def test_edges(spark):
    got = L.identify_language(edge_frame(spark)).collect()
    assert len(got) == len(edge_rows())
    for r in got:
        assert r["lang_pred"] in ("en", "und")
        if r["doc_id"] in (4, 5, 6):
            assert r["lang_pred"] == "und" and r["score"] == 0
    assert L.identify_language(empty_frame(spark)).count() == 0
    nothing = L.identify_language(edge_frame(spark).selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}


def test_rows_that_share_an_id_or_a_text_keep_their_language(spark):
    """3,000 German rows with one id (distinct or equal texts) next to English ones: German stays learnable."""
    german = ["der hund und die katze sind nicht in dem haus", "wir haben das wetter heute schön gefunden"]
    english = "the dog and the cat are not in the house while we think about weather"
    for distinct in (True, False):
        for shared in (1, 3, 4):
            rows = [(shared, f"{german[i % 2]} {i if distinct else ''}", "de") for i in range(3000)]
            rows += [(i, f"{english} {i}", "en") for i in range(100, 700)]
            docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
            got = {r["lang_pred"] for r in L.identify_language(docs).where(f"doc_id = {shared}").select("lang_pred").distinct().collect()}
            assert got == {"de"}
