"""URL filters: domain rules, and logistic regression on hashed character n-grams of host and
path for the URLs that no rule decides.

The classifier is trained from a small labelled table of URLs (a parameter; the default is
written out below).  Rules are looked up by the suffixes of a host, so their number doesn't
matter to a row; the longest one that fits decides.

Scale: narrow, one pass over the URLs; the model is one vector of ``SIZE`` numbers."""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, ship
from .linear import Linear, bucket, fit

SIZE = 1 << 14
GRAMS = (3, 4, 5)

# The rules (verdict, host and path prefix)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))

# The small labelled table: invented URLs of sites that are worth reading, and of sites that are not.
GOOD = """
https://www.university.edu/research/papers/2019
https://library.college.edu/catalog/history
https://news.daily.org/world/2021/05/article
https://blog.developer.io/posts/learning-python
https://docs.project.org/en/latest/tutorial.html
https://en.wiki.org/wiki/Photosynthesis
https://museum.city.gov/exhibitions/ancient-art
https://www.health.gov/topics/nutrition
https://journal.science.org/articles/volume-12
https://www.recipes.net/soup/tomato
https://forum.gardening.net/en/7817
https://stories.books.com/chapters/12
https://www.weather.gov/forecast/today
https://archive.history.org/documents/letters
https://www.school.edu/courses/mathematics
https://help.software.com/guide/install
https://maps.travel.org/europe/cities
https://press.institute.org/releases/2020
https://m.reader.net/de/1570
https://blog.writer.org/fr/7424.html
https://www.council.gov/en/1291/
https://text.poetry.org/en/873
https://www.theatre.org/program/season
https://www.astronomy.edu/observatory/stars
https://film.review.com/essays/classics
https://opinion.paper.com/columns/editorial
https://www.linguistics.edu/grammar/verbs
https://ocean.research.org/expedition/log
https://code.community.org/questions/4033
https://music.archive.org/concerts/symphony
https://garden.example.org/en/8423
https://lectures.example.org/en/482/
https://m.bridges.example.net/de/5989
https://valley.example.org/de/6137
https://www.orchestra.example.org/en/2210.html
https://blog.harbour.example.net/en/7442
""".split()
BAD = """
http://www.casino-win.com/play/slots
http://m.casino-palace.example.org/en/4033.html
http://best-casino.net/bonus
http://online-casino-bonus.biz/register
https://free-spins.example.org/en/5462
http://free-bets.info/odds/football
http://sports-bets.net/win/today
http://bet-now.xyz/jackpot
https://www.buy-cheap-pills.example.net/de/6652.html
http://cheap-pills.biz/order/viagra
http://buy-pills-online.info/cialis
http://cheap-meds.net/pharmacy/no-prescription
http://viagra-store.biz/cheap
http://xxx-videos.net/adult/free
http://adult-cams.info/live/girls
http://hot-porn.xyz/movies
http://sexy-dates.biz/meet
http://free-money.info/winner/prize
http://lottery-winner.biz/claim
http://win-prizes.xyz/click
http://payday-loans.info/apply/now
http://quick-loan-cash.biz/credit
http://cheap-watches.net/replica/rolex
http://replica-bags.info/discount
http://lucky-slots.com/spin
http://poker-bonus.net/deposit
http://crypto-profit.xyz/double
http://get-rich-fast.biz/money
http://miracle-diet.info/lose-weight
http://seo-links.biz/buy/backlinks
http://cheap-traffic.net/clicks
http://warez-download.xyz/crack/keygen
http://free-download-crack.info/serial
http://torrent-movies.biz/full
http://hot-deals.xyz/coupon
http://followers-buy.info/likes
http://www.casino-jackpot.example.org/en/77.html
http://win-casino.example.net/fr/210
https://m.free-bets-now.example.org/de/915
http://cheap-pills-shop.example.org/fr/31.html
http://blog.online-bets.example.net/en/6021
http://best-casino-win.example.org/es/448
""".split()


def host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; null or no :// gives ''."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """From the host's end up to ? # or the end; null or no :// gives ''."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


class RuleSet:
    """Rules by host; the longest that fits a URL decides (of equal ones the first given)."""

    def __init__(self, rules):
        self.by_host: dict[str, list] = {}
        for verdict, text in rules:
            domain, slash, rest = text.partition("/")
            self.by_host.setdefault(domain, []).append((text, slash + rest, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best = None
        for domain in suffixes(host):
            for text, prefix, verdict in self.by_host.get(domain, ()):
                if path.startswith(prefix) and (best is None or len(text) > len(best[0])):
                    best = (text, verdict)
        return best


def suffixes(host: str):
    """The host and the domains above it."""
    while host:
        yield host
        _, _, host = host.partition(".")


def features(host: str, path: str, size: int = SIZE) -> list[int]:
    """Places of the hashed character n-grams, host and path apart, each once."""
    out = set()
    for field, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in GRAMS:
            out.update(bucket(field + text[k:k + n], size) for k in range(len(text) - n + 1))
    return sorted(out)


def train(labelled: DataFrame, size: int = SIZE, reg: float = 0.002) -> Linear:
    """Fit on a small (url, block 0/1) table; rows with a null are left out.  A table of one class
    gives a model that always answers it, an empty one a model that always allows."""
    rows = labelled.filter("url is not null and block is not null").select(host(F.col("url")).alias("h"), path(F.col("url")).alias("p"), F.col("block").cast("double").alias("y"))
    where = F.udf(lambda h, p: features(h, p, size), "array<int>")
    places = where("h", "p")
    rows = rows.select(places.alias("places"), "y").withColumn("values", F.transform("places", lambda _: F.lit(1.0)))
    model = fit(rows.select("places", "values", F.col("y").alias("p"), F.lit(1.0).alias("weight")), size, reg=reg)
    if model is None:
        import numpy as np

        share = rows.agg(F.avg("y")).first()[0]
        model = Linear(np.zeros(size), 40.0 if share else -40.0)
    return model


def default_labelled(spark) -> DataFrame:
    return spark.createDataFrame([(u, 0) for u in GOOD] + [(u, 1) for u in BAD], "url string, block int")


def judge(pages: DataFrame, url_col: str = "url", *, labelled: DataFrame | None = None, rules=RULES, size: int = SIZE) -> DataFrame:
    """``pages`` with host, path, rule (null where none fits), score (the classifier's probability
    that the URL should be blocked) and verdict.

    Null URLs and those without :// have empty host and path and no rule; the classifier judges
    them like any other.  Repeated rows are judged alike; an empty table gives an empty result;
    columns named as the new ones are replaced."""
    spark = pages.sparkSession
    new = ("host", "path", "rule", "score", "verdict")
    model = train(default_labelled(spark) if labelled is None else labelled, size)
    shared = spark.sparkContext.broadcast((model.weights, model.bias))
    kept = [c for c in pages.columns if c not in new or c == url_col]
    rows = pages.select(*kept, host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", rule string, score double, verdict string"

    def run(batches):
        known, lin = RuleSet(rules), Linear(*shared.value)
        for b in batches:
            texts, scores, verdicts = [], [], []
            for h, p in zip(b.column("host").to_pylist(), b.column("path").to_pylist()):
                rule, s = known.find(h, p), score(lin, h, p)
                texts.append(rule and rule[0]), scores.append(s)
                verdicts.append(rule[1] if rule else "block" if s >= 0.5 else "allow")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string()), pa.array(scores, pa.float64()), pa.array(verdicts, pa.string())],
                                             names=[*b.schema.names, *new[2:]])

    def score(lin, h, p):
        at = features(h, p, size)
        return lin.score(at, [1.0] * len(at))

    return rows.mapInArrow(run, schema)


ship(__name__)
