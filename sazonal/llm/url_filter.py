"""URL filtering: list rules first, then logistic regression on hashed character n-grams.

Host and path are cut into overlapping character n-grams, which are hashed into a vector; the
weights come from a small labelled table of URLs. All of it is Spark SQL and Spark ML.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower

#: Lengths of the n-grams, and log2 of the hashed features.
GRAMS, FEATURE_BITS = (3, 4, 5), 18

#: Domain with a path prefix, and what it says.
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)

# Labelled URLs, written for this package: hosts of the kinds that web filters list, and
# ordinary ones. 1: block.
LABELLED_URLS = (
    ("https://www.casino-royal.example.org/slots/play", 1),
    ("http://casino-online.example.net/win/big", 1),
    ("https://big-win-casino.example.com/jackpot", 1),
    ("http://m.best-casino.example.org/en/12", 1),
    ("https://lucky-win.example.net/en/4411.html", 1),
    ("https://free-casino-spins.example.com/de/5", 1),
    ("https://poker-bets.example.org/tables", 1),
    ("http://sports-bets.example.net/odds/today", 1),
    ("https://free-bets-now.example.com/fr/812", 1),
    ("https://www.bets-bonus.example.org/signup", 1),
    ("http://cheap-meds.example.net/buy/pills", 1),
    ("https://cheap-pills-online.example.com/order", 1),
    ("https://pills-shop.example.org/en/77", 1),
    ("http://blog.discount-pills.example.net/es/4/", 1),
    ("https://spam-list.example.com/mail/1", 1),
    ("http://link-farm.example.org/links/9", 1),
    ("https://www.spam-links-farm.example.net/de/55?page=2", 1),
    ("https://seo-farm.example.com/en/881", 1),
    ("https://ads-server.example.org/banner?id=3", 1),
    ("http://track-clicks.example.net/pixel.gif", 1),
    ("https://m.ads-click-track.example.com/en/9", 1),
    ("https://adserver-track.example.org/fr/90.html", 1),
    ("https://adult-videos.example.net/watch/1", 1),
    ("http://xxx-adult.example.com/gallery", 1),
    ("https://blog.adult-cams.example.org/es/71#top", 1),
    ("https://porn-tube.example.net/xxx/22", 1),
    ("https://news.morning-post.example.com/world/2020/story", 0),
    ("https://www.garden-club.example.org/en/231", 0),
    ("https://blog.mountain-walks.example.net/fr/8821", 0),
    ("http://m.townhall.example.com/de/77/", 0),
    ("https://library.example.org/catalogue/item/42", 0),
    ("https://www.history-notes.example.net/es/501.html", 0),
    ("https://university.example.com/en/courses?page=2&ref=x", 0),
    ("http://recipes.homecooking.example.org/soup/9", 0),
    ("https://blog.northern-light.example.net/en/1200#top", 0),
    ("https://www.weather-station.example.com/fr/33/", 0),
    ("https://wiki.openbooks.example.org/page/Tree", 0),
    ("http://museum.example.net/exhibitions/1998", 0),
    ("https://m.theatre-review.example.com/en/9021?utm_source=feed", 0),
    ("https://shop.woodwork.example.org/tools/saw", 0),
    ("https://forum.birdwatch.example.net/de/4410", 0),
    ("http://www.riverside-school.example.com/en/6", 0),
    ("https://docs.software.example.org/guide/install.html", 0),
    ("https://blog.thingstoread.example.net/es/8", 0),
    ("https://science.example.com/articles/physics/7", 0),
    ("http://m.anotherthing.example.org/fr/3221.html", 0),
    ("https://www.interesting.example.net/en/48", 0),
    ("https://theatre.example.com/de/1290?page=2", 0),
    ("https://blog.otherstation.example.org/en/77#top", 0),
    ("https://m.health-advice.example.net/en/child/sleep", 0),
    ("http://www.northern-farmers.example.com/en/market", 0),
    ("https://address-book.example.org/de/2", 0),
    ("http://www.casino-night.example.org/en/31", 1),
    ("https://win-today.example.com/de/8", 1),
    ("http://bets.example.net/en/2", 1),
    ("https://free-slots.example.com/en/9#top", 1),
    ("https://buy-cheap.example.org/fr/6.html", 1),
    ("http://cheap-watches.example.net/es/3", 1),
    ("https://www.pills.example.com/en/14?page=2&ref=x", 1),
    ("https://spam.example.org/de/1/", 1),
    ("http://m.farm-of-spam.example.com/en/90", 1),
    ("https://ads.example.com/en/7?utm_source=feed", 1),
    ("http://track.example.net/fr/18", 1),
    ("https://blog.ads-pixel.example.org/en/66/", 1),
    ("https://adult.example.com/en/5", 1),
    ("http://www.adult-chat-x.example.net/es/27", 1),
    ("https://blog.tenor.example.com/en/9", 0),
    ("http://thistle.example.org/en/812.html", 0),
    ("https://www.throne.example.net/fr/5", 0),
    ("https://m.lantern.example.com/de/61#top", 0),
    ("http://station.example.org/es/7/", 0),
    ("https://another.example.com/en/4411?utm_source=feed", 0),
    ("https://thousand.example.net/en/33", 0),
    ("http://m.therapist.example.org/en/2019", 0),
    ("https://blog.nation.example.com/fr/72?page=2&ref=x", 0),
    ("https://www.shining.example.com/en/600", 0),
    ("https://earth.example.org/de/2.html", 0),
    ("https://m.southern.example.com/en/81/", 0),
    ("http://heath.example.net/es/19#top", 0),
    ("https://ration.example.com/en/450", 0),
    ("https://m.ounces.example.org/en/8797.html", 0),
    ("http://moths.example.org/en/2301", 0),
    ("https://tenths.example.org/en/17/", 0),
    ("https://m.months.example.org/de/4012#top", 0),
    ("https://www.depths.example.com/en/93?page=2&ref=x", 0),
    ("https://continent.example.org/en/5566", 0),
    ("http://m.payment.example.org/en/310.html", 0),
    ("https://monument.example.com/en/7210/", 0),
    ("https://blog.parents.example.com/en/64", 0),
    ("https://plants.example.org/es/905?utm_source=feed", 0),
    ("https://m.essays.example.com/en/2877", 0),
    ("http://paths.example.com/en/146.html", 0),
    ("https://www.tents.example.org/en/38", 0),
    ("https://m.clothes.example.org/en/7/", 0),
    ("https://months.example.com/de/319", 0),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty
    without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits host and path, else null. A rule fits its
    domain and all below it where the path starts with the rule's; of equally long ones the
    first by text."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        domain, slash, below = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(
            path, F.lit(slash + below)
        )
        out = F.when(
            fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        ).otherwise(out)
    return out


def _grams(part: str, mark: str) -> Column:
    """Character n-grams of a column between boundary signs, told apart by ``mark``."""
    text = F.concat(F.lit("^"), F.col(part), F.lit("$"))

    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda at: F.concat(F.lit(mark), F.substring(text, at, F.lit(n))))

    return F.concat(*[of_length(n) for n in GRAMS])


def _with_grams(df: DataFrame) -> DataFrame:
    return df.withColumn("grams", F.concat(_grams("host", "h"), _grams("path", "p")))


def fit_urls(spark: SparkSession, labelled=LABELLED_URLS) -> PipelineModel:
    """Logistic regression with an L2 penalty on the n-grams of (url, label) rows."""
    rows = spark.createDataFrame(list(labelled), "url string, label int").coalesce(1)
    rows = _with_grams(rows.select(
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.col("label").cast("double").alias("label"),
    ))
    stages = [
        HashingTF(inputCol="grams", outputCol="features", numFeatures=1 << FEATURE_BITS, binary=True),
        LogisticRegression(
            featuresCol="features", labelCol="label", regParam=0.002, maxIter=100, standardization=False
        ),
    ]
    return Pipeline(stages=stages).fit(rows)


def judge_urls(
    pages: DataFrame, model: PipelineModel | None = None, url_col: str = "url", rules=RULES,
    keep: tuple[str, ...] = ("page_id",),
) -> DataFrame:
    """Columns ``keep`` with (host, path, rule, verdict, block_score), one row per page.

    A fitting rule decides; else the regression's probability of block does, from 0.5 on.
    Null urls and urls without ``://`` have an empty host and path: no rule fits, and the
    regression sees no letters. A repeated page is judged as often as it comes; an empty
    table gives no rows.
    """
    model = model or fit_urls(pages.sparkSession)
    parts = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"),
        host_of(F.col(f"`{url_col}`")).alias("host"), path_of(F.col(f"`{url_col}`")).alias("path"),
    )
    scored = model.transform(_with_grams(parts)).select(
        "kept", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("found"),
        vector_to_array("probability")[1].alias("block_score"),
    )
    return scored.select(
        "kept.*", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(
            F.col("found.verdict"),
            F.when(F.col("block_score") >= 0.5, F.lit("block")).otherwise(F.lit("allow")),
        ).alias("verdict"),
        "block_score",
    )
