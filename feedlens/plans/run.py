"""M4: the whole digest run as one driver function over Parquet stages.

raw       entries as ingested (A2/A3 or an adapter), and the unique articles (E1)
processed the period's numbered articles (F1, C1/C2) and its profile (E11)
final     selection table, script documents, link posts (M3, R1, R4)

Stages are written tables, which also cut lineage between the steps; each step
reads the previous stage back, so a failed step can be re-run on its own.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from ..operators.dedup import merge_by_key
from ..operators.filters import DAY_COLUMN, resolve_range
from ..operators.ordering import number_articles
from ..sources.sinks import stage_path, write_articles, write_documents, write_stage
from .jobs import DEFAULT_LEXICONS, Lexicons, digest_documents, period_profile, query_period


def run_digest(spark: SparkSession, raw: DataFrame, out_root: str, as_of, run_id: str | None = None,
               start=None, end=None, days: int | None = None,
               lexicons: Lexicons = DEFAULT_LEXICONS, period: list[str] | None = None) -> dict:
    start_d, end_d = resolve_range(start, end, days, as_of)
    run_id = run_id or _dt.datetime.now().strftime("%Y%m%d_%H%M%S")
    out = {"run_id": run_id, "range": (str(start_d), str(end_d))}

    out["raw"] = write_stage(raw, out_root, run_id, "raw", "entries")
    raw = spark.read.parquet(out["raw"])
    folder = stage_path(out_root, run_id, "raw")
    write_articles(number_articles(merge_by_key(raw)), folder)
    out["unique"] = f"{folder}/articles"
    queried = query_period(spark.read.parquet(out["unique"]), start_d, end_d).drop(DAY_COLUMN)
    out["processed"] = write_stage(queried, out_root, run_id, "processed", "articles")
    queried = spark.read.parquet(out["processed"])
    out["profile"] = write_stage(period_profile(queried, start_d, end_d, as_of), out_root, run_id,
                                 "processed", "profile")

    docs = digest_documents(queried, as_of, lexicons, period)
    out["selection"] = write_stage(docs["selection"], out_root, run_id, "final", "selection")
    p = list(period or [])
    for name in ("script", "post", "post_compact"):
        path = f"{out_root.rstrip('/')}/run_id={run_id}/stage=final/{name}"
        write_documents(docs[name], path, name if name != "post_compact" else "post", partition_by=p)
        out[name] = path
    return out
