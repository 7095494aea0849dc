"""The operators of this subpackage as registered queries over whole tables.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE_SQL`` has DuckDB SQL
for those that SQL can express, the others are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (fillmiddle, htmltext, langid, mixing, neighbours, packing, periods, sharding, simhash, tokencounts, toxicity,
               urlfilter, vafile)
from .common import ship, table

#: Searches ask for this many neighbours of every row whose id the step divides.
TOP, QUERY_STEP = 20, 20
#: Texts of more tokens are over the limit.
TOKEN_LIMIT = 2048

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = query
        if sql is not None:
            ORACLE_SQL[name] = sql
        return query
    return deco


@register("op1_language_id")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs, hold=False)
    return found.select("doc_id", "held_out", "prediction.lang_pred", "prediction.score", "prediction.cross_entropy",
                        "prediction.rejected")


@register("op2_url_redirects", urlfilter.oracle_sql())
def op2(spark, sf_dir):
    return urlfilter.judge(table(spark, sf_dir, "pages"))


@register("op3_projected_neighbours")
def op3(spark, sf_dir):
    return neighbours.search(table(spark, sf_dir, "embeddings"), lambda c: c % QUERY_STEP == 0, TOP)


@register("op4_virtual_slots")
def op4(spark, sf_dir):
    rows, _ = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "next_shard")


@register("op5_simhash_dedup")
def op5(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op6_wrapper_text")
def op6(spark, sf_dir):
    text = htmltext.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register("op7_source_mix")
def op7(spark, sf_dir):
    return mixing.allocate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


@register("op8_concat_and_cut")
def op8(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


@register("op9_toxicity")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = toxicity.judge(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "held_out", F.col("toxicity").alias("score"),
                         F.expr("int(toxicity >= 0.5)").alias("predicted"))


@register("op10_va_file")
def op10(spark, sf_dir):
    return vafile.search(table(spark, sf_dir, "embeddings"), lambda c: c % QUERY_STEP == 0, TOP)


@register("op11_token_counts")
def op11(spark, sf_dir):
    counts = tokencounts.stored(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@register("op12_fill_in_middle", fillmiddle.oracle_sql())
def op12(spark, sf_dir):
    return fillmiddle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op13_periodic_runs")
def op13(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periods.periodic_runs(docs, text=periods.planted(F.col("doc_id"), F.col("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select("doc_id", "n_runs", (-F.col("best.col2")).alias("start"), F.col("best.length").alias("length"),
             (-F.col("best.col3")).alias("period"), F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
             "runs_sha256", "collapsed_sha256")
