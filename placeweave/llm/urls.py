"""URL filter: rules on host and path first, logistic regression on hashed character n-grams for the rest.

The regression is trained from a small labelled table of URLs, all of it on the JVM: n-grams are cut with
SQL functions, hashed into a fixed number of buckets by ``HashingTF`` and weighed by ``LogisticRegression``.
Judging is one narrow pass over the pages; nothing is shuffled.

A null URL or one without ``://`` has an empty host and path, fits no rule and is judged by the regression
(its intercept). Repeated rows are judged one by one; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm.shared import ascii_lower, query, table

BUCKETS = 1 << 14
SIZES = (3, 4, 5)
BLOCK_FROM = 0.5

# The rules of the filter, as (host and path prefix, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

# The labelled table that the regression is trained from.
UNWANTED = (
    "casino-royal.example.com/play/12", "www.best-casino.example.org/en/3", "win-casino-online.example.com/slots",
    "m.casino-bonus.example.org/de/77", "casino-win-big.example.com/fr/8", "jackpot-win.example.org/en/401", "slots-win.example.com/es/9/",
    "lucky-casino.example.net/en/65.html", "free-casino.example.org/en/15", "poker-bets.example.com/en/31",
    "sports-bets.example.org/fr/5", "free-bets-now.example.com/de/18.html", "www.bets365.example.org/en/22",
    "bet-tips.example.com/es/90", "free-bet.example.net/en/640", "quick-bets.example.com/en/7/", "free-spins.example.org/en/54",
    "cheap-pills-online.example.com/en/6", "buy-pills.example.org/de/83", "m.diet-pills.example.com/en/44", "pills-shop.example.net/fr/112",
    "cheap-meds.example.org/en/50", "www.cheap-viagra.example.com/en/19", "cheap-rx-pills.example.org/es/27", "cheap-loans.example.com/en/94",
    "spam-site.example.org/en/2", "www.link-farm.example.com/en/11", "link-farm-spam.example.org/de/36", "seo-farm.example.com/en/708",
    "blog.spam-blog.example.org/fr/21", "content-farm.example.com/en/130.html", "spamfarm.example.net/en/60", "mail-spam.example.com/es/35",
    "adult-chat.example.com/en/69", "www.adult-video.example.org/en/71", "adult-x-tube.example.com/de/4", "xxx-adult.example.org/fr/58",
    "m.adult-dating.example.com/en/33", "adult-x-cams.example.net/es/13", "x-adult.example.org/en/99", "sexy-adult.example.com/en/48",
    "ads-server.example.com/en/10", "track-ads.example.org/de/45", "ads-tracking.example.com/en/86", "www.ad-track.example.org/en/29",
    "click-track.example.com/fr/17", "adserver-track.example.net/en/501", "banner-ads.example.org/en/63", "pop-ads.example.com/es/74",
    "tracker-ads.example.com/en/39.html", "win-prize.example.org/en/52", "free-money-win.example.com/en/88", "cheap-replica.example.org/en/40",
    "www.grand-casino.com/play/3", "m.cheappills.net/en/14", "bestcasino.org/slots/8", "www.pills-direct.com/shop/2", "m.casinobets.net/en/70",
    "www.adultcams.com/de/5", "spamlinks.org/fr/33", "www.trackads.net/en/91", "poker-casino.com/en/6", "www.buypills.org/es/12",
)
WANTED = (
    "www.library.example.org/en/12", "garden.example.com/en/33", "blog.travel-notes.example.com/fr/8", "weather.example.org/de/4",
    "m.recipes.example.com/es/17", "history.example.org/en/501", "theatre.example.com/en/77.html", "www.ththeory.example.org/en/9",
    "mathematics.example.com/de/60", "northern.example.org/fr/28", "brother.example.com/en/14/", "nation.example.org/en/83",
    "station.example.com/es/41", "education.example.org/en/640", "motion.example.com/en/22", "www.weathering.example.org/en/5",
    "another.example.com/fr/90", "leather.example.org/en/31", "blog.thornton.example.com/en/19", "earth.example.org/de/70",
    "m.health.example.com/en/66", "truth.example.org/es/25", "thistle.example.com/en/47", "the-harbour.example.org/en/86",
    "thunder.example.com/en/13.html", "therapy.example.org/fr/58", "thesis.example.com/en/94", "think.example.org/en/3",
    "www.throne.example.com/de/29", "thread.example.org/en/71", "thousand.example.com/en/36", "thing.example.org/es/52",
    "blog.tradition.example.com/en/11", "fiction.example.org/en/45", "action.example.com/fr/18", "solution.example.org/en/408",
    "m.museum.example.com/en/7", "river.example.org/de/99", "mountain.example.com/en/63", "www.school.example.org/en/20",
    "village.example.com/es/39", "music.example.org/en/54", "science.example.com/en/2/", "forest.example.org/fr/74",
    "blog.kitchen.example.com/en/50", "newspaper.example.org/en/88", "bridge.example.com/de/16", "painting.example.org/en/27",
    "www.university.example.com/en/130", "island.example.org/en/44", "railway.example.com/fr/65", "birds.example.org/es/10",
    "www.gather.example.com/en/35", "whether.example.org/en/48", "either.example.com/de/69", "together.example.org/en/21",
    "hearth.example.com/en/6", "breath.example.org/fr/15", "ethnic.example.com/en/40", "method.example.org/en/112",
    "www.citylibrary.com/en/3", "m.gardening.net/en/14", "schoolmuseum.org/en/8", "www.weather-direct.com/news/2", "m.mountainbikes.net/en/70",
    "www.newspapers.com/de/5", "universitypress.org/fr/33", "www.railways.net/en/91", "science-history.com/en/6", "www.kitchens.org/es/12",
)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The training table: url, label (1: unwanted)."""
    rows = [(f"https://{u}", 1.0) for u in UNWANTED] + [(f"https://{u}", 0.0) for u in WANTED]
    return spark.createDataFrame(rows, "url string, label double").coalesce(1)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def _grams(host: Column, path: Column) -> Column:
    """Distinct character n-grams of host and path; the two ends of each are marked, and host and path never share one."""
    def cut(text: Column, tag: str) -> list[Column]:
        # Each size grows from the one below by one character, so that a very long URL costs no more than its length.
        letters = F.filter(F.split(text, ""), lambda c: c != "")
        grams, out = letters, []
        for n in range(2, max(SIZES) + 1):
            later = F.slice(letters, F.lit(n), F.greatest(F.size(letters) - F.lit(n - 1), F.lit(0)))
            grams = F.array_compact(F.zip_with(grams, later, lambda g, c: F.concat(g, c)))
            if n in SIZES:
                out.append(F.transform(grams, lambda g: F.concat(F.lit(tag), g)))
        return out
    site = F.concat(F.lit("^"), host, F.lit("$"))
    words = F.concat(F.lit("^"), F.regexp_replace(path, r"[0-9]+", "0"), F.lit("$"))
    return F.array_distinct(F.flatten(F.array(*cut(site, "h"), *cut(words, "p"))))


def _features(urls: DataFrame, host: Column, path: Column, buckets: int) -> DataFrame:
    grams = urls.withColumn("__grams", _grams(host, path))
    return HashingTF(inputCol="__grams", outputCol="__features", numFeatures=buckets, binary=True).transform(grams)


def train(urls: DataFrame, *, url: str = "url", label: str = "label", buckets: int = BUCKETS,
          penalty: float = 0.01) -> LogisticRegressionModel:
    """Fit the regression on a labelled table (1: unwanted). The table is small and known beforehand."""
    frame = _features(urls.select(F.col(url), F.col(label).alias("__label")), host_of(F.col(url)), path_of(F.col(url)), buckets)
    return LogisticRegression(featuresCol="__features", labelCol="__label", regParam=penalty, maxIter=60, standardization=False,
                              rawPredictionCol="", predictionCol="", probabilityCol="__probability").fit(frame)


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits: its host is the url's or a parent of it, and the url's path starts with its path."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def judge(pages: DataFrame, model: LogisticRegressionModel, *, url: str = "url", rules=RULES,
          block_from: float = BLOCK_FROM, keep: tuple[str, ...] = ()) -> DataFrame:
    """host, path, rule, verdict and the regression's score for every row; ``keep`` names further columns to pass on."""
    kept = F.struct(*keep) if keep else F.lit(None)
    parts = pages.select(kept.alias("__kept"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    scored = model.transform(_features(parts, F.col("host"), F.col("path"), model.numFeatures))
    scored = scored.withColumn("score", vector_to_array("__probability")[1]).withColumn(
        "rule", matching_rule(F.col("host"), F.col("path"), rules))
    by_rule = reduce(lambda rest, r: F.when(F.col("rule") == r[0], F.lit(r[1])).otherwise(rest), rules,
                     F.when(F.col("score") >= block_from, F.lit("block")).otherwise(F.lit("allow")))
    return scored.select(*([f"__kept.{k}" for k in keep]), "host", "path", "rule", by_rule.alias("verdict"), "score")


@query()
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), train(labelled_urls(spark)), keep=("page_id",))
