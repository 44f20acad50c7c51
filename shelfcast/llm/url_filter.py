"""URL filter: site rules first, then the ratio of two character language models; DataFrame operations only.

Urls that a rule decides teach two variable-order Markov models, one of accepted and one of rejected urls.
The probability of a character after its context interpolates all orders up to ``ORDER`` with
Witten-Bell weights: the more often a context was seen, and the fewer characters followed it, the more its
own counts weigh against those of the next shorter one. The models are tables by the real strings and
grow with the urls. The distinct grams of all urls, those that teach and those that are only judged, are
counted by shuffle and given their two probabilities order by order. What a gram adds to a score is then
looked up for every place of the distinct urls: in a broadcast table while that has at most ``BROADCAST``
rows, beyond that the most frequent grams, which would be hot keys, are broadcast and the others shuffled.
The score is the difference of the two log-likelihoods per character. Its threshold is
calibrated on a fifth of the ruled urls, which neither model has seen: the cut with the least sum of the
shares of accepted urls below and rejected ones above it.

Defined results: a null url, or one without ``://``, has empty host and path and no rule; an empty url has
score 0; equal urls are judged alike and each occurrence teaches; without ruled urls of a class, or none
left for calibration, the threshold is 0, and what reaches it is allowed. Of rules of equal length that fit,
a blocking one wins. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.workspace import materialize

ORDER = 4
#: A check that hashes grams needs so many buckets to agree with these tables, which have the strings.
BUCKETS = 1 << 64
#: Grams whose shares in the score are broadcast at most.
BROADCAST = 1 << 18
#: Characters that a context may be followed by, for the lowest order.
ALPHABET = 256
#: Width of a score bin in calibration.
STEP = 0.01
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SIDES = ("allow", "block")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(pages: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, url, host, path, rule and its verdict, null where no rule fits."""
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The last that fits wins, so the longest comes last.
    for r in sorted(rules, key=lambda r: (len(str(r)), r.verdict == "block")):
        inside = (F.col("host") == r.host) | F.col("host").endswith(f".{r.host}")
        fits = inside & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, F.lit(str(r))).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rows.select("*", rule.alias("rule"), verdict.alias("ruled"))


def _characters(url: Column) -> Column:
    """The characters of the lower-cased url after ``ORDER`` blanks, which no context of a real one has."""
    own = F.filter(F.split(F.coalesce(F.translate(url, UPPER, LOWER), F.lit("")), ""), lambda c: c != "")
    return F.concat(F.array_repeat(F.lit(""), ORDER), own)


def _grams(urls: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Columns ``keep`` and, for each character, the gram of it after its context of ``ORDER`` characters.

    Blanks before the url vanish, so a gram that is shorter than its order begins the url.
    """
    characters = F.col("characters")
    n = F.size(characters)
    gram = lambda at: F.array_join(F.slice(characters, at, ORDER + 1), "")
    places = F.when(n > ORDER, F.transform(F.sequence(F.lit(1), n - ORDER), gram))
    cut = urls.select(*keep, _characters(F.col("url")).alias("characters"))
    return cut.select(*keep, F.explode(places).alias("gram"))


def count_grams(urls: DataFrame) -> DataFrame:
    """Every gram of the distinct ``urls`` with its places in them and its counts n_allow and n_block.

    ``urls`` has url and, under the name of each side, how often it teaches that model.
    """
    counts = [F.sum(s).alias(f"n_{s}") for s in SIDES]
    return materialize(_grams(urls, SIDES).groupBy("gram").agg(F.count("*").alias("places"), *counts), "url-grams")


def log_ratios(grams: DataFrame) -> DataFrame:
    """(gram, places, ratio): log-probability of the last character as accepted less that as rejected.

    Of each order come the grams of all urls, also those that no model has seen. A context or a shorter gram
    meets at most as many grams as there are characters, so no key is hot.
    """
    orders = [grams]
    for k in range(ORDER - 1, -1, -1):
        shorter = orders[0].groupBy(F.right("gram", F.lit(k + 1)).alias("gram"))
        orders.insert(0, materialize(shorter.agg(*[F.sum(f"n_{s}").alias(f"n_{s}") for s in SIDES]), f"url-order-{k}"))
    last = None
    for k, own in enumerate(orders):
        own = own.withColumn("context", F.left("gram", F.length("gram") - 1))
        totals = [F.sum(f"n_{s}").cast("double").alias(f"total_{s}") for s in SIDES]
        # An unseen context passes the shorter one's probability on.
        kinds = [F.greatest(F.count_if(F.col(f"n_{s}") > 0).cast("double"), F.lit(1e-9)).alias(f"kinds_{s}") for s in SIDES]
        joined = own.join(own.groupBy("context").agg(*totals, *kinds), "context")
        p = dict.fromkeys(SIDES, F.lit(1.0 / ALPHABET))
        if last is not None:
            joined = joined.withColumn("shorter", F.right("gram", F.lit(k))).join(last, "shorter")
            p = {s: F.col(f"p_{s}") for s in SIDES}
        p = {s: (F.col(f"n_{s}") + F.col(f"kinds_{s}") * p[s]) / (F.col(f"total_{s}") + F.col(f"kinds_{s}")) for s in SIDES}
        last = joined.select(F.col("gram").alias("shorter"), *[p[s].alias(f"p_{s}") for s in SIDES])
    ratio = (F.log(p["allow"]) - F.log(p["block"])).alias("ratio")
    return materialize(joined.select("gram", "places", ratio), "url-ratios")


def scores(urls: DataFrame, ratios: DataFrame, limit: int = BROADCAST) -> DataFrame:
    """(h1, h2, score): log-likelihood as accepted less that as rejected, per character of every url.

    ``urls`` has h1 and h2 beside url. At most ``limit`` rows of ``ratios`` are broadcast.
    """
    size = ratios.agg(F.count("*").alias("grams"), F.coalesce(F.sum("places"), F.lit(0)).alias("places")).first()
    # No more than ``limit`` grams can have this share of all places each.
    least = 0 if size["grams"] <= limit else size["places"] / limit
    places = _grams(urls, ["h1", "h2"])
    often = F.broadcast(ratios.where(F.col("places") >= least).select("gram", "ratio"))
    found = places.join(often, "gram").select("h1", "h2", "ratio")
    if least:
        rare = ratios.where(F.col("places") < least).select("gram", "ratio")
        others = places.join(often, "gram", "left_anti").join(rare, "gram")
        found = found.unionByName(others.select("h1", "h2", "ratio"))
    return found.groupBy("h1", "h2").agg(F.avg("ratio").alias("score"))


def threshold(scored: DataFrame) -> DataFrame:
    """One row with column cut; ``scored`` has side and score of urls that taught no model."""
    good, bad = (F.sum((F.col("side") == s).cast("int")) for s in SIDES)
    bins = scored.groupBy(F.floor(F.col("score") / STEP).alias("bin")).agg(
        good.alias("good"), bad.alias("bad"))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # A cut below a bin rejects the good ones before it and accepts the bad ones from it on; it lies in the
    # middle of the gap to the bin before.
    middle = (F.col("bin") + F.coalesce(F.lag("bin").over(Window.orderBy("bin")) + 1, F.col("bin"))) * (STEP / 2)
    lost = F.try_divide(F.coalesce(F.sum("good").over(below), F.lit(0)), F.sum("good").over(every))
    kept = 1 - F.try_divide(F.coalesce(F.sum("bad").over(below), F.lit(0)), F.sum("bad").over(every))
    cuts = bins.select(middle.alias("cut"), (lost + kept).alias("loss")).where("loss IS NOT NULL")
    best = F.min(F.struct("loss", F.abs("cut").alias("size"), "cut"))
    return cuts.agg(F.coalesce(best["cut"], F.lit(0.0)).alias("cut"))


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row."""
    names = [F.xxhash64("url").alias("h1"), F.xxhash64(F.lit("url"), "url").alias("h2")]
    rows = ruled(pages, rules).select("*", *names)
    kept_back = F.pmod(F.xxhash64(F.lit("calibration"), "url"), F.lit(5)) == 0
    examples = rows.where("ruled IS NOT NULL").withColumnRenamed("ruled", "side")
    taught = [F.count_if((F.col("ruled") == s) & ~kept_back).alias(s) for s in SIDES]
    distinct = materialize(rows.groupBy("h1", "h2").agg(F.first("url").alias("url"), *taught), "url-distinct")
    found = materialize(scores(distinct, log_ratios(count_grams(distinct))), "url-scores")
    held = examples.where(kept_back).select("h1", "h2", "side").join(found, ["h1", "h2"])
    cut = materialize(threshold(held), "url-threshold")
    scored = rows.join(found, ["h1", "h2"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    own = F.when(F.col("score") >= cut.scalar(), "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score")
