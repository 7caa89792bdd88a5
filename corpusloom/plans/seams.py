"""Where models come in: a provider gets batches of prompts and gives replies. No network is used here."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import joins
from corpusloom.shared import written

#: One call: prompt and model to reply; raises on failure.
Call = Callable[[str, str], str]
REPLY = "array<struct<path: string, reply: string, error: string>>"


def with_fallback(call: Call, first: str, fallback: str, attempts: int = 2):
    """Column function of a prompt: tries of the first model, then of the fallback, each with its outcome; the last one counts."""

    @F.pandas_udf(REPLY)
    def run(prompts: pd.Series) -> pd.Series:
        def of(prompt):
            log = []
            for model in [first] * attempts + [fallback]:
                try:
                    log.append({"path": model, "reply": call(prompt, model), "error": None})
                    break
                except Exception as e:  # a failure of any kind moves on to the next try
                    log.append({"path": model, "reply": None, "error": str(e)})
            return log

        return prompts.map(of)

    return run


class Refused(Exception):
    """The model declined: a retry is pointless."""


class RateLimited(Exception):
    """The model is busy: a later round may succeed."""


class OutOfCredits(Exception):
    """Nothing more can be paid for: the rest of the run waits for a later round."""


ANSWERS = "seed string, model string, status string, reply string"


def answered(pairs: DataFrame, call: Call, streak: int | None = 4, check: Callable[[], bool] | None = None, every: int = 25) -> DataFrame:
    """Replies to ``pairs`` (``seed``, ``model``): ``seed``, ``model``, ``status``, ``reply`` (the error's text without one).

    Status: ``ok``, ``refused``, ``rate limited``, ``failed``; ``skipped`` after ``streak`` failures in a row of a model
    in a task; ``out of credits`` for the pair that ran into it and all later ones of its task, and for those left when
    ``check`` (asked before each ``every`` pairs) says no. Outcomes are data: a later run takes those it may try again.
    """

    def run(batches):
        bad: dict[str, int] = {}
        n, stopped = 0, False
        for rows in batches:
            out = []
            for s, m in zip(rows["seed"], rows["model"], strict=True):
                if check is not None and n % every == 0 and not stopped:
                    stopped = not check()
                n += 1
                if stopped:
                    out.append((s, m, "out of credits", None))
                    continue
                if streak is not None and bad.get(m, 0) >= streak:
                    out.append((s, m, "skipped", None))
                    continue
                try:
                    out.append((s, m, "ok", call(s, m)))
                    bad[m] = 0
                except Refused as e:
                    out.append((s, m, "refused", str(e)))
                except RateLimited as e:
                    out.append((s, m, "rate limited", str(e)))
                except OutOfCredits as e:
                    stopped = True
                    out.append((s, m, "out of credits", str(e)))
                except Exception as e:  # the outcome is data
                    bad[m] = bad.get(m, 0) + 1
                    out.append((s, m, "failed", str(e)))
            yield pd.DataFrame(out, columns=["seed", "model", "status", "reply"])

    return pairs.select(F.col("seed").cast("string").alias("seed"), F.col("model").cast("string").alias("model")).mapInPandas(run, ANSWERS)


def fan_out(seeds: DataFrame, models: list[str], call: Call, seed: str = "seed", streak: int = 4) -> DataFrame:
    """``answered`` for all models and all seeds."""
    return answered(seeds.select(F.col(seed).alias("seed")).withColumn("model", F.explode(F.lit(models))), call, streak)


def resumed(seeds: DataFrame, models: DataFrame, before: DataFrame, call: Call, streak: int | None = 4) -> DataFrame:
    """A run that goes on where the runs ``before`` (rows of ``answered``) ended.

    Pairs that are ok or refused stay as they are; all others are tried, and what comes back replaces what was there.
    """
    settled = before.where(F.col("status").isin("ok", "refused"))
    pairs = joins.missing_pairs(seeds, models, settled, "seed", "model")
    return settled.unionByName(answered(pairs, call, streak))


def until_quota(cells: DataFrame, ask: Callable[[str, int], list[str]], reason: Callable[[str, str], str | None], most_calls: int) -> DataFrame:
    """Lines that a model gives for each ``cell`` (with its ``quota``): ``cell``, ``call``, ``line``, ``reason`` (null if accepted).

    A cell is asked again (``ask(cell, call)``) until its quota of accepted lines is met or ``most_calls`` are made. A line
    is rejected by ``reason(cell, line)``, or as a repeat within its cell; lines after the quota are not looked at. A call
    that fails counts as one without lines. Cells are independent, so each is one row for a task.
    """

    def run(batches):
        for rows in batches:
            out = []
            for cell, quota in zip(rows["cell"], rows["quota"], strict=True):
                seen: set[str] = set()
                n = 0
                for call in range(most_calls):
                    if n >= quota:
                        break
                    try:
                        lines = ask(cell, call)
                    except Exception as e:  # the outcome is data
                        out.append((cell, call, None, f"failed: {e}"))
                        continue
                    for line in lines:
                        if n >= quota:
                            break
                        why = "repeat" if line in seen else reason(cell, line)
                        if why is None:
                            seen.add(line)
                            n += 1
                        out.append((cell, call, line, why))
            yield pd.DataFrame(out, columns=["cell", "call", "line", "reason"])

    return cells.select(F.col("cell").cast("string").alias("cell"), F.col("quota").cast("int").alias("quota")).mapInPandas(run, "cell string, call int, line string, reason string")


def annotated(seeds: DataFrame, worth: Call, annotators: list[str], annotate: Call, adjudicate: Call) -> dict[str, DataFrame]:
    """Three routes of sentences (``seed``): ``skipped`` with a reason, ``candidates`` of all annotators, ``adjudicated``.

    ``worth`` says why a sentence is not worth annotating, or gives an empty text; ``annotate`` answers for each annotator;
    ``adjudicate`` gets the sentence and the candidates as lines. Failures are reasons, not errors: of the detection, of
    all annotators, of the adjudicator. Frames are written tables, so no call is made twice.
    """
    found = written(answered(seeds.select("seed").withColumn("model", F.lit("detection")), worth, None), "detected")
    failed = found.where("status <> 'ok'").select("seed", F.concat(F.lit("detection error: "), "reply").alias("reason"))
    dull = found.where("status = 'ok' and reply <> ''").select("seed", F.col("reply").alias("reason"))
    good = found.where("status = 'ok' and reply = ''").select("seed")
    replies = written(answered(good.withColumn("model", F.explode(F.lit(annotators))), annotate, None), "annotated")
    candidates = replies.where("status = 'ok'").select("seed", F.col("model").alias("annotator"), F.col("reply").alias("candidate"))
    silent = good.join(candidates.select("seed").distinct(), "seed", "left_anti").select("seed", F.lit("all annotators failed").alias("reason"))
    bundle = candidates.groupBy("seed").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("annotator", "candidate"))), lambda c: c["candidate"]), "\n").alias("model"))
    verdicts = written(answered(bundle, adjudicate, None), "adjudicated")
    undecided = verdicts.where("status <> 'ok'").select("seed", F.concat(F.lit("adjudicator error: "), "reply").alias("reason"))
    return {
        "adjudicated": verdicts.where("status = 'ok'").select("seed", F.col("reply").alias("verdict")),
        "candidates": candidates,
        "skipped": failed.union(dull).union(silent).union(undecided),
    }
