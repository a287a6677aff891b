from .rng import keyed_uniform, uniform_sql  # noqa: F401
from . import vectors, training  # noqa: F401
