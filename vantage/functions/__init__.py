"""Column-expression helpers (JVM-side, codegen friendly)."""

from .vectors import as_doubles, dot, sq_dist, dist, norm_sq, lit_matrix, lit_vector, matvec, argmin_dist  # noqa: F401
from .hashing import hash32, hash_unit, hash_bucket  # noqa: F401
