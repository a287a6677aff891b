"""Vector expressions on ARRAY<FLOAT|DOUBLE> columns, evaluated JVM-side with
higher-order functions (no Python in the row path).  Arithmetic is DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
COSINE_NORM_FLOOR = 1e-8      # cosine is 0 and normalise is a no-op below this norm
PCA_NORM_FLOOR = 1e-10        # normalise floor used by the PCA power iteration


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    """sum(a[i] * b[i]) in DOUBLE."""
    return F.aggregate(
        F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def dot_fixed(a, b, dim: int) -> Column:
    """dot for a dimension known when the plan is built: an explicit sum of
    element products, which whole-stage codegen compiles (higher-order
    functions are interpreted).  Same left-to-right order as ``dot``."""
    a, b = _c(a), _c(b)
    acc = F.lit(0.0).cast("double")
    for j in range(dim):
        acc = acc + a[j].cast("double") * b[j].cast("double")
    return acc


def sq_norm(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0).cast("double"),
                       lambda acc, x: acc + x.cast("double") * x.cast("double"))


def norm(a) -> Column:
    return F.sqrt(sq_norm(a))


def cosine(a, b) -> Column:
    """Cosine clamped to [-1, 1]; 0 when either norm is below 1e-8."""
    na, nb = norm(a), norm(b)
    raw = dot(a, b) / (na * nb)
    return (F.when((na < COSINE_NORM_FLOOR) | (nb < COSINE_NORM_FLOOR), F.lit(0.0))
            .otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), raw))))


def normalize(a, floor: float = COSINE_NORM_FLOOR) -> Column:
    """a / |a|, or a unchanged (as DOUBLE) when |a| < floor."""
    n = norm(a)
    return F.when(n < floor, F.transform(_c(a), lambda x: x.cast("double"))) \
        .otherwise(F.transform(_c(a), lambda x: x.cast("double") / n))


def add(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") + y.cast("double"))


def sub(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") - y.cast("double"))


def scale(a, s) -> Column:
    s = s if isinstance(s, Column) else F.lit(float(s))
    return F.transform(_c(a), lambda x: x.cast("double") * s)


def axpy(alpha, x, y) -> Column:
    """y + alpha * x, element-wise."""
    alpha = alpha if isinstance(alpha, Column) else F.lit(float(alpha))
    return F.zip_with(_c(x), _c(y), lambda xi, yi: yi.cast("double") + alpha * xi.cast("double"))


def to_float_array(a) -> Column:
    return F.transform(_c(a), lambda x: x.cast("float"))


def literal_vector(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def dims_sum_exprs(col, dim: int, prefix: str) -> list[Column]:
    """One SUM aggregate per dimension (map-side partial aggregation)."""
    return [F.sum(_c(col)[j]).alias(f"{prefix}{j}") for j in range(dim)]


def assemble(prefix: str, dim: int) -> Column:
    return F.array(*[F.col(f"{prefix}{j}") for j in range(dim)])
