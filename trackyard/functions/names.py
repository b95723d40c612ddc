"""Header and file-name expressions: routing (S3), normalisation (S4), sanitising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackyard.schemas import ROUTING


def route_source(file_name) -> Column:
    """Lower-cased file name -> target table by the precedence chain, else NULL."""
    name = F.lower(F.col(file_name) if isinstance(file_name, str) else file_name)
    expr = None
    for table, tokens in ROUTING:
        cond = None
        for tok in tokens:
            c = name.contains(tok)
            cond = c if cond is None else cond & c
        expr = F.when(cond, F.lit(table)) if expr is None else expr.when(cond, F.lit(table))
    return expr


# white space as a text reader strips it, Unicode's and the separators of ASCII included
_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def normalise_header(c, keep_case: bool | Column = False) -> Column:
    """strip (any white space), and lower unless ``keep_case``."""
    bare = F.regexp_replace(F.col(c) if isinstance(c, str) else c, _EDGES, "")
    return F.when(keep_case if isinstance(keep_case, Column) else F.lit(keep_case), bare).otherwise(F.lower(bare))


def sanitise_name(c) -> Column:
    """Non ``[a-zA-Z0-9_]`` -> ``_``, strip ``_`` at both ends, lower."""
    col = F.col(c) if isinstance(c, str) else c
    replaced = F.regexp_replace(col, r"[^a-zA-Z0-9_]", "_")
    return F.lower(F.regexp_replace(replaced, r"^_+|_+$", ""))
