"""URL filter: fixed rules first, then logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.llm.common import UPPER, LOWER

#: Fixed rules: (rule, verdict); a rule is a host, a slash and a path.
RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]

#: Fixed small table of labelled URLs (host and path), by verdict.
LABELLED_BLOCK = """
spam-farm.example.org/en/1 www.spam-farm.example.net/de/22 spamlinks.example.org/a spam.example.io/fr/8
cheap-pills.example.org/en/20 www.cheap-pills.example.net/de/5 pills-online.example.org/shop buy-pills.example.io/es/3
cheap-meds.example.org/offer pharmacy-deals.example.net/buy viagra-shop.example.org/en/9 discount-pills.example.biz/7
casino-win.example.org/en/4 m.casino-win.example.net/de/77 online-casino.example.org/slots casino.example.io/fr/1
best-casino-bonus.example.net/play slots-jackpot.example.org/en/3 poker-win.example.biz/de/2 jackpot.example.io/win
free-bets.example.org/en/90 www.free-bets.example.net/de/31 sports-bets.example.org/odds bets.example.io/fr/2
betting-tips.example.net/free free-bet-bonus.example.biz/en/6 freebets.example.org/es/4 win-bets.example.io/1
ads-track.example.org/en/12 m.ads-track.example.net/de/8 ad-tracker.example.org/pixel track-ads.example.io/fr/3
ads.example.net/banner tracking-ads.example.biz/en/1 popads.example.org/click adserver.example.io/ads/7
adult-x.example.org/en/42 blog.adult-x.example.net/de/3 adult-video.example.org/xxx adult.example.io/fr/5
xxx-cams.example.net/live sex-chat.example.biz/en/2 porn-tube.example.org/es/9 hot-xxx.example.io/de/1
payday-loans.example.org/en/3 cheap-replica-watches.example.net/buy crypto-giveaway.example.biz/win torrent-warez.example.io/en/4
"""
LABELLED_ALLOW = """
www.library.example.org/en/1 news.example.net/de/22 museum.example.org/a gazette.example.io/fr/8
blog.garden.example.org/en/20 www.recipes.example.net/de/5 m.weather.example.org/today school.example.io/es/3
travel.example.org/en/9 history.example.net/archive www.science.example.org/en/4 m.physics.example.net/de/77
wiki.example.org/page forum.example.io/fr/1 docs.example.net/guide chess.example.org/en/3
football.example.biz/de/2 music.example.io/es/11 www.art.example.org/en/90 mathematics.example.net/de/31
open-data.example.org/sets health.example.io/fr/2 city-council.example.net/minutes www.university.example.biz/en/6
river-trust.example.org/es/4 astronomy.example.io/1 blog.baking.example.org/en/12 m.cinema.example.net/de/8
old-maps.example.org/sheet theatre.example.io/fr/3 languages.example.net/verbs bird-watch.example.biz/en/1
railways.example.org/timetable harbour.example.io/photos/7 mountains.example.org/en/42 blog.gardeners.example.net/de/3
poetry.example.org/read letters.example.io/fr/5 www.tionre.example.net/live m.thanor.example.biz/en/2
blog.ererth.example.org/es/9 theand.example.io/de/1 onthe.example.org/en/3 www.eshwh.example.net/en/7
blog.inthti.example.org/en/4 m.reonst.example.net/de/6 andhe.example.io/fr/640 www.leanou.example.org/en/19
ingtion.example.net/de/511 blog.nderer.example.org/fr/31 m.blehe.example.org/en/882 wheer.example.net/en/15.html
"""

FEATURES = 1 << 14
SIZES = (3, 4, 5)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL: host up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path up to ``?``, ``#`` or the end."""
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits host (or a parent domain) and start of path, else null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def grams(host: Column, path: Column, sizes: Sequence[int] = SIZES) -> Column:
    """Character n-grams of host and path, the host's marked apart from the path's."""

    def of(text: Column, mark: str, n: int) -> Column:
        return F.when(
            F.length(text) >= n,
            F.transform(
                F.sequence(F.lit(1), F.length(text) - (n - 1)),
                lambda i: F.concat(F.lit(mark), F.substr(text, i, F.lit(n))),
            ),
        ).otherwise(F.array().cast("array<string>"))

    lists = [of(F.concat(F.lit("^"), host, F.lit("$")), "h", n) for n in sizes]
    lists += [of(path, "p", n) for n in sizes[:1]]
    return F.concat(*lists)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table: ``url, label`` (1 = block)."""
    block, allow = LABELLED_BLOCK.split(), LABELLED_ALLOW.split()
    items = [F.struct(F.lit(f"http://{u}").alias("url"), F.lit(1.0).alias("label")) for u in block]
    items += [F.struct(F.lit(f"http://{u}").alias("url"), F.lit(0.0).alias("label")) for u in allow]
    return spark.range(1).select(F.inline(F.array(*items)))


def _vectors(df: DataFrame) -> DataFrame:
    tf = HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol="_features")
    return tf.transform(df.withColumn("_grams", grams(F.col("_host"), F.col("_path"))))


def train(labelled: DataFrame):
    """Fit on ``url, label`` rows (1 = block); None when a class is missing."""
    host, path = split_url(F.col("url"))
    rows = _vectors(labelled.where("label is not null").select("label", host.alias("_host"), path.alias("_path")))
    if rows.select("label").distinct().count() < 2:
        return None
    return LogisticRegression(featuresCol="_features", labelCol="label", regParam=0.003, maxIter=60).fit(rows)


def url_filter(
    pages: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    threshold: float = 0.5,
) -> DataFrame:
    """Verdict on every URL: the longest fitting rule's, else the classifier's.

    Returns ``id_col, host, path, rule, score, verdict`` (``score``: the
    probability of ``block``).  Features and scores are DataFrame and Spark ML
    transformers over one scan, without a shuffle; the model is a vector of
    ``FEATURES`` weights, whatever the input.  It is fitted on ``labelled``
    (``url, label``; a small table by definition), the built-in one by default.

    Edge cases: a null URL or one without ``://`` has an empty host and path,
    fits no rule, and is scored by the intercept alone; with labels of one
    class only every URL without a rule is allowed with score 0; rows are
    judged one by one, so repeated rows repeat; an empty table gives an empty
    result; other columns are ignored.
    """
    model = train(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    host, path = split_url(pages[url_col])
    rows = pages.select(pages[id_col].alias("_id"), host.alias("_host"), path.alias("_path"))
    if model is None:
        rows = rows.withColumn("_score", F.lit(0.0))
    else:
        model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_probability")
        rows = model.transform(_vectors(rows)).withColumn("_score", vector_to_array("_probability")[1])
    rule = rule_of(F.col("_host"), F.col("_path"), rules)
    by_rule = F.lit(None).cast("string")
    for name, verdict in rules:
        by_rule = F.when(F.col("rule") == name, F.lit(verdict)).otherwise(by_rule)
    method = F.when(F.col("_score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return rows.withColumn("rule", rule).select(
        F.col("_id").alias(id_col),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        "rule",
        F.col("_score").alias("score"),
        F.coalesce(by_rule, method).alias("verdict"),
    )
