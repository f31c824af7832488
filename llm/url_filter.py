"""URL filter: host and path rules first, a logistic model for the rest.

The model is a logistic regression on hashed character n-grams of host and path, trained
from a small table of labelled URLs. Everything is DataFrame code: n-grams are slices of
the text, hashing and the regression are MLlib's and run in the JVM.
"""

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from llm.frames import lower_ascii

# The rules of the list, host and path and verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

# Hand-labelled URLs, 1 to block and 0 to allow.
LABELLED = [
    ("https://casino-bonus.example/win/jackpot", 1), ("http://free-pills.example/buy/cheap", 1),
    ("http://xxx-videos.example/hot/watch", 1), ("https://track.ads.example/click?id=1", 1),
    ("https://poker-online.example/slots/free-spin", 1), ("http://adult-chat.example/live", 1),
    ("https://loans-fast.example/credit/now", 1), ("http://cheap-watches.example/replica", 1),
    ("https://banner.ads.example/popup/offer", 1), ("http://torrent-crack.example/keygen", 1),
    ("https://betting-tips.example/odds/win", 1), ("http://seo-links.example/buy-backlinks", 1),
    ("https://docs.library.example/guide/start", 0), ("https://www.university.example/en/research", 0),
    ("https://blog.science.example/2024/05/article", 0), ("http://news.city.example/world/report", 0),
    ("https://en.wiki.example/article/history", 0), ("https://museum.example/collection/painting", 0),
    ("https://www.health.example/fr/conseils", 0), ("http://archive.example/books/text.html", 0),
    ("https://m.weather.example/de/berlin", 0), ("https://journal.example/issue/12/paper", 0),
    ("https://school.example/es/curso/historia", 0), ("https://code.example/project/readme", 0),
]

#: Features of the model; a bound on what is learned and sent with the plan.
DIMENSIONS = 4096
SIZES = (3, 4)


def parsed(urls, url="url"):
    """The rows with ``host`` and ``path`` of their URL, any such columns replaced."""
    raw = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.locate("://", raw)
    rest = F.when(at > 0, F.substr(raw, at + 3)).otherwise(F.lit(""))
    return urls.withColumns({
        "host": lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def rule_of(host, path, rules):
    """The longest rule that fits, as struct(rule, verdict), or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"),
                                      F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def grams(host, path, sizes=SIZES):
    """Character n-grams of ``^host|path$``, repeats included."""
    text = F.concat(F.lit("^"), host, F.lit("|"), path, F.lit("$"))

    def of(n):
        return F.when(F.length(text) >= n, F.transform(
            F.sequence(F.lit(1), F.length(text) - n + 1),
            lambda i: F.substr(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.concat(*[of(n) for n in sizes])


def _hashed(dimensions):
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=dimensions)


def train(spark, labelled=None, dimensions=DIMENSIONS, sizes=SIZES):
    """The fitted model of a small table of (url, label) pairs."""
    pairs = F.array(*[F.struct(F.lit(u).alias("url"), F.lit(float(y)).alias("label"))
                      for u, y in labelled or LABELLED])
    rows = spark.range(0, 1, 1, 1).select(F.inline(pairs))
    rows = parsed(rows).withColumn("grams", grams(F.col("host"), F.col("path"), sizes))
    return LogisticRegression(maxIter=60, regParam=0.01).fit(_hashed(dimensions).transform(rows))


def filter_urls(pages, rules=None, labelled=None, threshold=0.5, dimensions=DIMENSIONS,
                sizes=SIZES):
    """``page_id, host, path, rule, verdict, score`` for each row of ``pages(page_id, url)``.

    The longest fitting rule decides; without one the model does: ``block`` where its
    ``score`` is at least ``threshold``. A null URL, or one without ``://``, has an empty
    host and path and is judged by the model. Rows may repeat, ids may be null; other
    columns, whatever their names, are left out. An empty table gives an empty result.
    """
    model = train(pages.sparkSession, labelled, dimensions, sizes)
    rows = parsed(pages.select("page_id", "url"))
    rows = rows.withColumns({"found": rule_of(F.col("host"), F.col("path"), rules or RULES),
                             "grams": grams(F.col("host"), F.col("path"), sizes)})
    scored = model.transform(_hashed(dimensions).transform(rows))
    score = vector_to_array(F.col("probability"))[1]
    return scored.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(score >= threshold, "block").otherwise("allow"))
        .alias("verdict"), score.alias("score"))
