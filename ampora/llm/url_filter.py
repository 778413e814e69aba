"""URL filter: host and path rules, then logistic regression on hashed character n-grams.

The model is learned from a small table of labelled URLs (``TRAINING`` rows at most, the first in hash
order) by ``STEPS`` steps of gradient descent.  A step is one DataFrame job: each row's score, then
the slope of every slot.  Only the slopes, ``SLOTS`` numbers, come to the driver.  Scores are SQL
expressions over the learned weights; there is no Python on the executors.

Rows: a null URL, or one without ``://``, has an empty host and path, fits no rule, and is judged by the
model's constant.  Without labelled URLs of both kinds everything that fits no rule is allowed.
Further columns are kept; clashing names raise ``ValueError``.  Repeated rows are judged alike.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

SLOTS = 4096
TRAINING = 2000
STEPS = 25
RATE = 1.0
#: (host and path, verdict); a rule fits its host and all subdomains if the URL's path starts with its path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def host(url: Column) -> Column:
    """From the first ``://`` up to a slash, question mark, number sign or the end; A-Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), upper, upper.lower())


def path(url: Column) -> Column:
    """What follows the host, up to a question mark, number sign or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule(host_of: Column, path_of: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule that fits, or null."""
    fitting = []
    for text, _ in sorted(rules, key=lambda r: -len(r[0])):
        domain, slash, rest = text.partition("/")
        fits = ((host_of == domain) | F.endswith(host_of, F.lit("." + domain))) & F.startswith(path_of, F.lit(slash + rest))
        fitting.append(F.when(fits, F.lit(text)))
    return F.coalesce(*fitting, F.lit(None).cast("string"))


def slots(host_of: Column, path_of: Column) -> Column:
    """Distinct slots of the 3- and 4-grams of ``^host$`` and ``^path$``."""
    grams = [_slots_of(mark, part, n) for mark, part in (("h", host_of), ("p", path_of)) for n in (3, 4)]
    return F.array_distinct(F.concat(*grams))


def _slots_of(mark: str, part: Column, n: int) -> Column:
    # letters and the letters after them, side by side: no lambda looks into a whole array
    letters = F.split(F.concat(F.lit("^"), part, F.lit("$")), "")
    grams = letters
    for k in range(1, n):
        grams = F.zip_with(grams, F.slice(letters, k + 1, F.size(letters)), lambda a, b: F.concat(a, b))
    whole = F.filter(grams, lambda g: g.isNotNull())
    return F.transform(whole, lambda g: F.pmod(F.xxhash64(F.lit(mark), g), F.lit(SLOTS)).cast("int"))


@dataclass
class Weights:
    """One weight per slot, and a constant."""

    slots: list[float]
    constant: float

    def logit(self, of: Column) -> Column:
        # one literal: the optimizer folds it to an array of numbers
        table = F.from_json(F.lit(json.dumps(self.slots)), "array<double>")
        total = F.aggregate(of, F.lit(0.0), lambda z, s: z + F.element_at(table, s + 1))
        return total / F.sqrt(F.greatest(F.size(of), F.lit(1))) + F.lit(self.constant)

    def score(self, of: Column) -> Column:
        """Probability of a URL that should be blocked."""
        return 1 / (1 + F.exp(-self.logit(of)))


def learn(spark: SparkSession, labelled: DataFrame) -> Weights | None:
    """Weights from a table (url, blocked 0/1); None unless it has both kinds."""
    chosen = (labelled.where("url IS NOT NULL AND blocked IS NOT NULL").select("url", F.col("blocked").cast("double").alias("y"))
              .distinct().orderBy(F.xxhash64("url"), "url", "y").limit(TRAINING))
    kept = scratch_path(spark, "labelled-urls")
    chosen.select("y", slots(host(F.col("url")), path(F.col("url"))).alias("of")).coalesce(1).write.parquet(kept)
    rows = spark.read.schema("y double, of array<int>").parquet(kept)
    n, blocked = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    if not 0 < blocked < n:
        return None
    w = Weights([0.0] * SLOTS, math.log(blocked / (n - blocked)))
    squares = [1e-8] * (SLOTS + 1)
    for _ in range(STEPS):
        error = rows.select("of", (w.score(F.col("of")) - F.col("y")).alias("e"))
        # the constant is slot -1, a part of every row
        each = error.select("e", (1 / F.sqrt(F.greatest(F.size("of"), F.lit(1)))).alias("v"),
                            F.explode(F.concat(F.array(F.lit(-1)), "of")).alias("slot"))
        slope = each.groupBy("slot").agg((F.sum(F.col("e") * F.when(F.col("slot") < 0, 1.0).otherwise(F.col("v"))) / n).alias("g"))
        for r in slope.collect():
            k = r["slot"]
            squares[k] += r["g"] ** 2
            move = RATE * r["g"] / math.sqrt(squares[k])
            if k < 0:
                w.constant -= move
            else:
                w.slots[k] -= move
    return w


def judge(pages: DataFrame, weights: Weights | None, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """``pages`` with host, path, rule, score and verdict of each url."""
    clash = {c.lower() for c in pages.columns} & {"host", "path", "rule", "score", "verdict"}
    if clash:
        raise ValueError(f"output columns already exist: {sorted(clash)}")
    parts = pages.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    ruled = parts.withColumn("rule", rule(F.col("host"), F.col("path"), rules))
    score = weights.score(slots(F.col("host"), F.col("path"))) if weights else F.lit(0.0)
    verdicts = F.create_map(*(F.lit(x) for r in rules for x in r))
    by_model = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return ruled.withColumn("score", score).withColumn(
        "verdict", F.when(F.col("rule").isNotNull(), F.get(F.map_values(verdicts), F.array_position(
            F.map_keys(verdicts), F.col("rule")).cast("int") - 1)).otherwise(by_model))
