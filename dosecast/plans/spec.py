"""Output typing shared by a Spark query and its oracle SQL.

A spec is ``"name:kind name:kind ..."`` with kinds ``l`` bigint, ``d`` double
rounded to 6 places, ``s`` string, ``b`` boolean, ``dt`` date and ``ts``
timestamp (both rendered as ISO strings so no engine-specific date type
reaches the value hash).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse(spec: str) -> list[tuple[str, str]]:
    out = []
    for tok in spec.split():
        n, k = tok.rsplit(":", 1)
        out.append((n, k))
    return out


def finalize(df: DataFrame, spec: str) -> DataFrame:
    cols = []
    for n, k in parse(spec):
        c = F.col(n)
        if k == "l":
            c = c.cast("long")
        elif k == "d":
            c = F.round(c.cast("double"), 6)
        elif k == "s":
            c = c.cast("string")
        elif k == "b":
            c = c.cast("boolean")
        elif k == "dt":
            c = F.date_format(c.cast("date"), "yyyy-MM-dd")
        elif k == "ts":
            c = F.date_format(c.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
        else:
            raise ValueError(k)
        cols.append(c.alias(n))
    return df.select(*cols)


def final_sql(body: str, spec: str) -> str:
    cols = []
    for n, k in parse(spec):
        q = f'"{n}"'
        if k == "l":
            e = f"cast({q} as bigint)"
        elif k == "d":
            e = f"round(cast({q} as double), 6)"
        elif k == "s":
            e = f"cast({q} as varchar)"
        elif k == "b":
            e = f"cast({q} as boolean)"
        elif k == "dt":
            e = f"strftime(cast({q} as date), '%Y-%m-%d')"
        elif k == "ts":
            e = f"strftime(cast({q} as timestamp), '%Y-%m-%d %H:%M:%S')"
        else:
            raise ValueError(k)
        cols.append(f"{e} as {q}")
    return f"select {', '.join(cols)} from (\n{body}\n) _q"
