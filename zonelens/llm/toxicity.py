"""Toxicity by weak supervision.

Voters: hand-written lexicons and patterns, and word or word-prefix patterns found in a bounded
sample of labelled rows, so that languages and vocabularies without a lexicon have voters too.
Label model: each voter has a rate of voting in toxic and in clean texts, estimated by EM over
the votes; voters that vote together beyond that share one vote (their votes are divided by
the number of voters they are correlated with).  Classifier: logistic regression on the voters
and on hashed words and word beginnings, fitted to the label model's posterior.

Only rows whose crc32(id as text) mod ``FOLDS`` is not 0 are ever learned from; labels, language,
source and id are no inputs of a score.

Scale: the fit reads at most ``SAMPLE`` labelled texts a class, chosen by the hash of their id;
scoring is one narrow pass with one weight vector of fixed size."""
from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, row_key, ship
from .linear import Linear, bucket, fit

FOLDS = 5
SAMPLE = 3000      # labelled texts a class that the fit may read
MINED = 256        # most patterns taken from the sample
SIZE = 1 << 16     # places of the hashed features
TRUST = 0.95       # accuracy that a given label is taken to have
PREFIXES = (4, 5, 6, 7)  # beginnings of words that may become voters
STEM = 5                 # the beginning that is hashed for the classifier, beside the whole word
WORD = re.compile(r"[^\W\d_]+")

# Hand-written voters: one lexicon a group, matched on whole words
LEXICONS = {
    "stupidity": "idiot idiots idiotic stupid moron morons moronic imbecile dumb dumbass fool retard cretin dimwit halfwit",
    "worth": "worthless useless pathetic loser losers failure nobody garbage trash rubbish",
    "disgust": "disgusting filthy scum vermin pig pigs dirtbag scumbag vile repulsive",
    "ridicule": "clown clowns freak weirdo crybaby snowflake laughingstock",
    "abuse": "bastard bitch asshole jerk dickhead prick whore slut cunt fuck fucking shit shitty",
    "threat": "murder strangle exterminate",
    "french": "connard connasse salope imbécile crétin débile ordure pourriture merde",
    "german": "idioten arschloch dummkopf trottel abschaum missgeburt schwachkopf versager drecksau",
    "spanish": "imbécil gilipollas estúpido estúpida basura escoria idiota cabrón puta mierda",
}
# Hand-written patterns over the lower-cased text
PATTERNS = {
    "you_are": r"\byou(?:'re| are)(?: \w+){0,3} (?:idiot|stupid|moron|pathetic|worthless|disgusting|scum|trash|loser|clown)",
    "such_a": r"\b(?:such an?|what an?|you) (?:\w+ )?(?:idiot|moron|loser|clown|scum|trash)",
    "go_away": r"\b(?:shut up|go to hell|drop dead|get lost)\b",
    "nobody_likes": r"\b(?:nobody|no one) (?:likes|wants|loves|cares about) you\b",
}


def remainder(id_col: Column) -> Column:
    """crc32(id as text) mod FOLDS; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


def beginnings(word: str) -> list[str]:
    """The pattern features of a word: itself and its beginnings."""
    return [f"={word}", *(f"^{word[:n]}" for n in PREFIXES if len(word) >= n)]


def text_features(text: str | None) -> set[str]:
    """The pattern features of a text's words; a beginning of two or more different words is the
    feature "2^" as well."""
    once, twice = set(), set()
    for w in set(WORD.findall((text or "").lower())):
        for g in beginnings(w):
            if g in once:
                twice.add(f"2{g}")
            once.add(g)
    return once | twice


@dataclass
class Voters:
    """The voters in their order: lexicons, patterns, mined features."""

    mined: list[str]

    def __post_init__(self):
        self.of_word: dict[str, list[int]] = {}
        self.of_start: dict[str, list[int]] = {}
        self.of_twice: dict[str, list[int]] = {}
        for k, words in enumerate(LEXICONS.values()):
            for w in words.split():
                self.of_word.setdefault(w, []).append(k)
        self.patterns = [(len(LEXICONS) + k, re.compile(p)) for k, p in enumerate(PATTERNS.values())]
        for k, f in enumerate(self.mined):
            table = self.of_word if f[0] == "=" else self.of_start if f[0] == "^" else self.of_twice
            table.setdefault(f.lstrip("=2^"), []).append(len(LEXICONS) + len(PATTERNS) + k)
        self.lengths = sorted({len(f) for f in (*self.of_start, *self.of_twice)})

    def __len__(self):
        return len(LEXICONS) + len(PATTERNS) + len(self.mined)

    def read(self, text: str | None) -> tuple[list[int], list[int]]:
        """(voters that vote, places of the hashed features) of one whole text, each once."""
        low = (text or "").lower()
        votes, seen, n = {k for k, p in self.patterns if p.search(low)}, set(), len(self)
        words = set(WORD.findall(low))
        for w in words:
            if w in self.of_word:
                votes.update(self.of_word[w])
            for size in self.lengths:
                g = w[:size]
                if len(g) == size:
                    if g in self.of_start:
                        votes.update(self.of_start[g])
                    if g in self.of_twice:
                        if g in seen:
                            votes.update(self.of_twice[g])
                        seen.add(g)
        half = SIZE // 2
        places = {n + bucket(w, half) for w in words}
        places.update(n + half + bucket(g, half) for g in {w[:STEM] for w in words})
        return sorted(votes), sorted(places)


def vector(votes: list[int], places: list[int]) -> tuple[list[int], np.ndarray]:
    """The linear model's input: votes at full weight, the hashed features at unit length together."""
    return [*votes, *places], np.concatenate([np.ones(len(votes)), np.full(len(places), 1.0 / np.sqrt(max(1, len(places))))])


@dataclass
class LabelModel:
    """Rates at which each voter votes in toxic and clean texts, its share of a vote, the rates of
    texts without any vote, the prior.  A voter that doesn't vote abstains: its silence says
    nothing (most texts are in languages it doesn't know), only that of all voters does."""

    toxic: np.ndarray
    clean: np.ndarray
    share: np.ndarray
    silent: tuple[float, float]
    prior: float

    def posterior(self, votes: np.ndarray, given: np.ndarray) -> np.ndarray:
        """P(toxic) for each row of the 0/1 vote matrix and its given label (one more voter)."""
        said = votes @ (self.share * np.log(self.toxic / self.clean))
        z = np.log(self.prior / (1 - self.prior)) + np.where(votes.any(1), said, np.log(self.silent[0] / self.silent[1]))
        z += np.where(given > 0, 1, -1) * np.log(TRUST / (1 - TRUST))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    @classmethod
    def fit(cls, votes: np.ndarray, given: np.ndarray, weight: np.ndarray, rounds: int = 25) -> LabelModel:
        """EM from the given labels; ``weight`` is how many texts a row stands for."""
        p, n = np.where(given > 0, TRUST, 1 - TRUST), votes.shape[1]
        share, mute = np.ones(n), ~votes.any(1)
        for r in range(rounds):
            a, b = weight * p, weight * (1 - p)
            rate = lambda w, x: np.clip((w @ x + 0.1) / (w.sum() + 1), 1e-4, 1 - 1e-4)
            toxic, clean = rate(a, votes), rate(b, votes)
            if r < 3:  # correlations within a class, from the first estimates
                rest = votes - p[:, None] * toxic - (1 - p[:, None]) * clean
                cov = (rest * weight[:, None]).T @ rest
                sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
                share = 1 / np.maximum(1, (np.abs(cov / sd[:, None] / sd) > 0.5).sum(1))
            model = cls(toxic, clean, share, (float(rate(a, mute)), float(rate(b, mute))), float(rate(weight, p)))
            p = model.posterior(votes, given)
        return model


@dataclass
class Model:
    voters: Voters
    linear: Linear

    def score(self, text: str | None) -> float:
        return float(self.linear.score(*vector(*self.voters.read(text))))


def _default() -> Model:
    """Without labels: the hand-written voters alone."""
    voters = Voters([])
    return Model(voters, Linear(np.concatenate([np.full(len(voters), 4.0), np.zeros(SIZE)]), -2.0))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on labelled rows outside the held-out fold; see the module's text for the bounds.  Null
    labels and ids are left out; an id labelled twice is toxic if it is so once.  Without rows of
    both classes the hand-written voters decide alone."""
    spark = docs.sparkSession
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (remainder(F.col(id_col)) != 0))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return _default()
    order = F.xxhash64(F.col("id").cast("string"))
    parts = [known.filter(F.col("y") == y).orderBy(order, "id").limit(SAMPLE).withColumn("weight", F.lit(max(1.0, counts[y] / SAMPLE))) for y in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # at most 2 * SAMPLE rows
    # one text an id; of rows with equal ids the one of smallest key
    texts = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    sample = texts.join(chosen, "id").groupBy("id").agg(F.min(F.struct("key", "text", "y", "weight")).alias("r"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sample = checkpointed(sample.select("r.text", "r.y", "r.weight").repartition(parts))

    def grams(batches):
        counts: dict[str, list[int]] = {}  # of this task's part of the sample
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for g in text_features(text):
                    counts.setdefault(g, [0, 0])[y] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *(pa.array([c[y] for c in counts.values()], pa.int64()) for y in (1, 0))],
                                         names=["g", "a", "b"])

    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return _default()
    df = sample.select("text", "y").mapInArrow(grams, "g string, a long, b long").groupBy("g").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    odds = F.log((F.col("a") + 0.25) / n[1]) - F.log((F.col("b") + 0.25) / n[0])
    best = df.filter(F.col("a") >= max(3, n[1] // 200)).withColumn("odds", odds).filter("odds > 2.5")
    mined = [r["g"] for r in best.orderBy((F.col("a") * F.col("odds")).desc(), "g").limit(MINED).collect()]
    voters = Voters(mined)

    def votes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([voters.read(t)[0] for t in b.column(0).to_pylist()], pa.list_(pa.int32())), b.column(1), b.column(2)],
                                             names=["votes", "y", "weight"])

    # rows with the same votes and label are one row: what reaches the driver is bounded by the sample
    rows = (sample.select("text", "y", "weight").mapInArrow(votes, "votes array<int>, y int, weight double")
            .groupBy("votes", "y").agg(F.sum("weight").alias("weight")).orderBy("votes", "y").collect())
    matrix = np.zeros((len(rows), len(voters)))
    for k, r in enumerate(rows):
        matrix[k, r["votes"]] = 1
    label_model = LabelModel.fit(matrix, np.array([r["y"] for r in rows]), np.array([r["weight"] for r in rows]))

    def posterior(batches):
        for b in batches:
            places, values, p = [], [], []
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                v, f = voters.read(t)
                at, x = vector(v, f)
                one = np.zeros((1, len(voters)))
                one[0, v] = 1
                places.append(at), values.append(x), p.append(float(label_model.posterior(one, np.array([y]))[0]))
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64())), pa.array(p, pa.float64()), b.column(2)],
                                             names=["places", "values", "p", "weight"])

    train_rows = sample.select("text", "y", "weight").mapInArrow(posterior, "places array<int>, values array<double>, p double, weight double")
    model = fit(train_rows, len(voters) + SIZE, reg=1e-5, iterations=100)
    return Model(voters, model) if model else _default()


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row of ``docs``.

    Null and empty texts get the score of a text without features; null ids are not held out;
    repeated rows are scored alike; an empty table gives an empty result; other columns are not
    read."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model.voters.mined, model.linear.weights, model.linear.bias))

    def run(batches):
        mined, weights, bias = shared.value
        own = Model(Voters(mined), Linear(weights, bias))
        for b in batches:
            s = [own.score(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.float64())], names=["id", "held_out", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(remainder(F.col(id_col)) == 0, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


ship(__name__)
