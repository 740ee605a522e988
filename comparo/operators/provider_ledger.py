"""A live provider asked through a ledger (X2): every prompt is paid for once, and a run that dies goes on where it stopped.

The ledger is a parquet folder with a row per question asked: the hash of provider name and prompt, the attempt, the
response or the error. Inputs are reduced to distinct prompts, those answered before are taken out by an anti join, and the rest are
dealt into batches by their hash. Each batch is asked by the tasks and appended to the ledger before the next begins, so a killed run
loses the answers of one batch at most. A prompt without an answer is asked again, up to ``max_attempts`` times over
all runs; its last error stays in the ledger. Answers never pass through the driver.

Another template or provider name makes other hashes, so old answers are kept and not taken for new ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comparo.operators.enrich import render_prompt
from comparo.session import materialize

LEDGER = "prompt_hash string, attempt int, response string, error string"
BATCH_ROWS = 10_000
MOST_BATCHES = 64  # of one attempt; with more prompts batches are larger

Answer = Callable[[list[str]], list[str | None]]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All questions asked so far; empty if there is no ledger yet."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def _asked(prompts: DataFrame, load_provider: Callable[[], Answer], rows: int) -> DataFrame:
    """Rows of the ledger for ``prompts`` (prompt_hash, attempt, prompt). What the provider raises is stored as the error of the
    prompts of that call."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = load_provider()
        for pdf in batches:
            for at in range(0, len(pdf), rows):
                part = pdf.iloc[at:at + rows]
                try:
                    found, error = list(answer(part["prompt"].tolist())), None
                    if len(found) != len(part):
                        raise ValueError(f"{len(found)} answers to {len(part)} prompts")
                except Exception as raised:  # the provider's, whatever it is
                    found, error = [None] * len(part), f"{type(raised).__name__}: {raised}"
                yield pd.DataFrame({"prompt_hash": part["prompt_hash"], "attempt": part["attempt"],
                                    "response": pd.Series(found, index=part.index, dtype=object),
                                    "error": pd.Series([error if r is None and error else "no answer" if r is None else None
                                                        for r in found], index=part.index, dtype=object)})

    return prompts.mapInPandas(run, LEDGER)


def ask_once(inputs: DataFrame, load_provider: Callable[[], Answer], template: str, ledger: str, provider: str = "provider",
             domain_col: str = "domain", max_attempts: int = 3, batch_rows: int = BATCH_ROWS, call_rows: int = 50) -> DataFrame:
    """(domain, response, attempts, error) for every distinct domain of ``inputs``.

    ``load_provider()`` is called once per task and returns a function from prompts to responses (None for no answer); it
    gets ``call_rows`` prompts at a time. Null domains are not asked."""
    spark = inputs.sparkSession
    domains = inputs.select(F.col(domain_col).cast("string").alias("domain")).where("domain IS NOT NULL").distinct()
    prompts = render_prompt(domains, template, "domain", "prompt")
    prompts = materialize(prompts.withColumn("prompt_hash", F.sha2(F.concat_ws("\n", F.lit(provider), F.col("prompt")), 256)),
                          "prompts")

    def state() -> DataFrame:
        return read_ledger(spark, ledger).groupBy("prompt_hash").agg(
            F.max("attempt").alias("attempts"), F.max(F.col("response").isNotNull()).alias("answered"),
            F.min_by("response", F.when(F.col("response").isNotNull(), F.col("attempt"))).alias("response"),
            F.max_by("error", "attempt").alias("error"))

    for _ in range(max_attempts):
        before = F.coalesce("attempts", F.lit(0))
        waiting = (prompts.select("prompt_hash", "prompt").distinct().join(state(), "prompt_hash", "left")
                   .where(~F.coalesce("answered", F.lit(False)) & (before < max_attempts))
                   .select("prompt_hash", (before + 1).cast("int").alias("attempt"), "prompt"))
        waiting = materialize(waiting, "waiting")
        batches = min(MOST_BATCHES, -(-waiting.count() // batch_rows))
        if not batches:
            break
        for batch in range(batches):
            part = waiting.where(F.pmod(F.xxhash64("prompt_hash"), F.lit(batches)) == batch)
            _asked(part, load_provider, call_rows).write.mode("append").parquet(ledger)
    found = prompts.join(state(), "prompt_hash", "left")
    return found.select("domain", "response", F.coalesce("attempts", F.lit(0)).alias("attempts"),
                        F.when(F.col("response").isNull(), F.col("error")).alias("error"))
