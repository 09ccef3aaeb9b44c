"""Streaming twins of the incremental batch jobs.

Input arrives in two deliveries and the stream is restarted between them, so the
second run starts from the checkpoint of the first. Each result equals that of
its batch twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewire.operators import dedup as dd
from tapewire.plans.news import HISTORY_SQL, STORE_SQL, history_parts, store
from tapewire.plans.registry import query
from tapewire.sources import news as nw
from tapewire.sources.files import scratch_folder
from tapewire.streaming import incremental as inc


def deliver(spark, name, parts, step, last_only=False, columns=None):
    """Run the job once per delivery and give the resulting table."""
    folder = scratch_folder(spark, name)
    schema = parts[0].schema
    target = schema if columns is None else parts[0].select(*columns).schema
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/in")
        inc.run_batches(inc.arrivals(spark, f"{folder}/in", schema), folder, target, step, last_only)
    return inc.read_table(spark, folder, last_only)


@query(
    "stream_append_dedup",
    f"WITH {HISTORY_SQL} SELECT ticker, title, pos, origin FROM joined QUALIFY row_number() OVER (PARTITION BY ticker, title ORDER BY p, pos) = 1",
)
def stream_append_dedup(spark, sf):
    return deliver(spark, "append", history_parts(spark, sf), inc.append_new(["ticker", "title"], ["pos"]))


@query("stream_resume", f"WITH {nw.ARTICLES_SQL} SELECT DISTINCT source, url FROM articles")
def stream_resume(spark, sf):
    rows = nw.articles(spark, sf).select("source", "url", "lang", "pos")
    first, second = rows.where("lang <> 'en'").drop("lang"), rows.drop("lang")
    return deliver(spark, "resume", [first, second], inc.append_new(["source", "url"], ["pos"])).select("source", "url")


@query(
    "stream_upsert",
    f"""WITH {STORE_SQL} SELECT url, coalesce(e.id, l.id) AS id, coalesce(e.source, l.source) AS source,
  {", ".join(f"CASE WHEN l.url IS NOT NULL THEN l.{c} ELSE e.{c} END AS {c}" for c in dd.UPDATED)} FROM existing e FULL JOIN latest l USING (url)""",
)
def stream_upsert(spark, sf):
    existing, incoming = store(spark, sf)
    columns = existing.columns
    started = existing.withColumn("pos", F.lit(0).cast("bigint"))
    return deliver(
        spark, "upsert", [started, incoming], inc.upsert_into("url", "pos", columns), last_only=True, columns=columns
    )
