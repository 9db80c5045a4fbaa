"""URL filter: host and path rules, and beyond them a ratio of two character language models.

The rules judge some URLs; those they accept and those they reject train one variable-order Markov
model each over the characters of host and path (Witten-Bell smoothing: a context that was seen
less trusts the next shorter one more). A URL without a rule is accepted if the difference of its
log-likelihoods, divided by its number of characters, reaches a threshold. A fifth of the judged
URLs, picked by hash, is not trained on; the threshold is the one that splits those best.

Everything is DataFrame work. Counts are pre-aggregated n-grams; probabilities are joined to the
distinct n-grams; URLs are scored once per distinct text, so copies of a URL cost nothing, and the
score join is a plain one whose hot n-grams Spark splits. The work is in proportion to the characters,
also of one very long URL.

A null URL or one without ``://`` has an empty host and path and no rule; it is scored like any
other (its only character is the end). Without URLs of both kinds the threshold is 0 and the models
are what counts there are. Repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmill.llm.common import stash

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters per n-gram: the predicted one and a context of up to four.
ORDER = 5
#: Probability of a character that no context knows: one of so many.
ALPHABET = 256
HELD_OUT = 5
#: Scores are binned by hundredths between these bounds to find the threshold.
BINS = 1000
#: Log ratios are added up as whole numbers of this part of one.
UNITS = 1_000_000_000


@dataclass(frozen=True)
class UrlRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


# The rules of the contract.
RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null URL or one without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """The longest rule that fits, as a struct of its text and verdict, or null."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = (
            (F.concat(F.lit("."), host).endswith(f".{rule.host}")) & path.startswith(rule.path)
        )
        own = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, own).otherwise(found)
    return found


def grams(texts: DataFrame, *keep: str) -> DataFrame:
    """Each character of ``site`` and the end mark, with the ORDER - 1 characters before it."""
    padded = F.concat(F.repeat(F.lit("\x02"), F.lit(ORDER - 1)), "site", F.lit("\x03"))
    places = F.sequence(F.lit(1), F.length("site") + 1)

    def windows(chars: Column) -> Column:
        return F.transform(places, lambda i: F.array_join(F.slice(chars, i, ORDER), ""))

    # As a lambda's argument the characters are cut once a text; a column of theirs would be put
    # into the inner lambda and cut again for every place.
    found = F.transform(F.array(F.split(padded, "")), windows)[0]
    return texts.select(*keep, F.explode(found).alias("gram"))


def log_ratios(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """log P(accepted) - log P(rejected) of the last character, for each distinct gram.

    ``counts`` has gram, accepted, rejected (how often it was seen); ``wanted`` has gram.
    """
    model = wanted.withColumns({k: F.lit(1.0 / ALPHABET) for k in ("accepted_p", "rejected_p")})
    for k in range(1, ORDER + 1):
        tail = F.right("gram", F.lit(k))
        seen = counts.groupBy(tail.alias("tail")).agg(
            *(F.sum(kind).alias(f"{kind}_n") for kind in ("accepted", "rejected"))
        )
        context = seen.groupBy(F.left("tail", F.lit(k - 1)).alias("context")).agg(
            *(F.sum(f"{kind}_n").alias(f"{kind}_all") for kind in ("accepted", "rejected")),
            *(
                F.count_if(F.col(f"{kind}_n") > 0).alias(f"{kind}_kinds")
                for kind in ("accepted", "rejected")
            ),
        )
        model = (
            model.withColumns({"tail": tail, "context": F.left(tail, F.lit(k - 1))})
            .join(seen, "tail", "left")
            .join(context, "context", "left")
            .na.fill(0)
        )
        smoothed = {
            f"{kind}_p": F.when(
                F.col(f"{kind}_all") > 0,
                (F.col(f"{kind}_n") + F.col(f"{kind}_kinds") * F.col(f"{kind}_p"))
                / (F.col(f"{kind}_all") + F.col(f"{kind}_kinds")),
            ).otherwise(F.col(f"{kind}_p"))
            for kind in ("accepted", "rejected")
        }
        model = model.select("gram", *(p.alias(name) for name, p in smoothed.items()))
    return model.select(
        "gram", (F.log("accepted_p") - F.log("rejected_p")).alias("ratio")
    )


def best_threshold(scores: DataFrame) -> float:
    """What splits accepted from rejected scores with the least balanced error; 0 without both.

    ``scores`` has score and accepted (boolean). At most 2 * (2 * BINS + 1) rows reach the driver.
    """
    binned = scores.select(
        F.least(F.greatest(F.floor(F.col("score") * 100), F.lit(-BINS)), F.lit(BINS)).alias("bin"),
        "accepted",
    )
    table = binned.groupBy("bin", "accepted").agg(F.count("*").alias("n")).collect()
    good = {r.bin: r.n for r in table if r.accepted}
    bad = {r.bin: r.n for r in table if not r.accepted}
    if not good or not bad:
        return 0.0
    n_good, n_bad = sum(good.values()), sum(bad.values())
    lost, passed = 0, n_bad
    errors = []
    for place in range(-BINS, BINS + 2):  # accept from this bin on
        errors.append((lost / n_good + passed / n_bad, abs(place), place))
        lost, passed = lost + good.get(place, 0), passed - bad.get(place, 0)
    least = min(errors)[0]
    ties = [place for error, _, place in errors if error == least]
    return ties[len(ties) // 2] / 100


def judge(
    pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, key: str = "page_id", url: str = "url"
) -> DataFrame:
    """``key``, host, path, rule, score (null where a rule decides) and verdict of every row."""
    host, path = host_and_path(F.col(url))
    parsed = (
        pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
        .select("key", host.alias("host"), path.alias("path"))
        .withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    )
    rows = stash(
        parsed.select(
            "key",
            "host",
            "path",
            F.concat("host", "path").alias("site"),
            F.col("found.text").alias("rule"),
            F.col("found.verdict").alias("verdict"),
        ),
        "urls",
    )
    held_out = F.pmod(F.xxhash64("site"), F.lit(HELD_OUT)) == 0
    sites = rows.groupBy("site").agg(
        F.max("rule").alias("rule"), F.max("verdict").alias("verdict")
    )
    # N-grams carry a number in place of their text.
    numbered = sites.withColumns({"held_out": held_out, "site_id": F.monotonically_increasing_id()})
    sites = stash(numbered, "url_sites")
    counts = stash(
        grams(sites.where("rule IS NOT NULL AND NOT held_out"), "verdict")
        .groupBy("gram")
        .agg(
            F.count_if(F.col("verdict") == "allow").alias("accepted"),
            F.count_if(F.col("verdict") != "allow").alias("rejected"),
        ),
        "url_grams",
    )
    asked = sites.where("rule IS NULL OR held_out")
    model = stash(log_ratios(counts, grams(asked).distinct()), "url_model")
    # Whole billionths: a sum of doubles would depend on the order of the rows.
    units = F.sum(F.round(F.col("ratio") * UNITS).cast("long"))
    means = (
        grams(asked, "site_id")
        .join(model, "gram")
        .groupBy("site_id")
        .agg((units / F.count("*") / UNITS).alias("score"))
    )
    scores = stash(means.join(asked, "site_id"), "url_scores")
    judged = scores.where("rule IS NOT NULL")
    accepted = (F.col("verdict") == "allow").alias("accepted")
    threshold = best_threshold(judged.select("score", accepted))
    own = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return rows.join(
        scores.where("rule IS NULL").select("site", "score"), "site", "left"
    ).select(
        F.col("key").alias(key),
        "host",
        "path",
        "rule",
        "score",
        F.coalesce("verdict", own).alias("verdict"),
    )
