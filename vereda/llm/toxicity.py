"""Toxicity by weak supervision.

Voters are words and word beginnings that the labelled rows suggest, and a few patterns of
writing; each fires on a document or not. All that pass a fixed test of support vote, and
near copies among the labelled rows support a word once. A generative label model, a mixture of two classes,
estimates by expectation maximisation how often each voter fires in either class; the labels
take part as one more voter of unknown accuracy. Voters that fire together beyond what the
classes explain share their say. A linear classifier is then trained on the posterior of the
model and scores every text.
"""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vereda.llm import simhash
from vereda.llm.common import text_of
from vereda.session import park

SAMPLE = 20_000  # labelled rows to learn from at most, chosen by a hash of the id
BEGINNINGS = (4, 5, 6, 8)  # letters of a word that may make a voter
SUPPORT = 3  # toxic texts, near copies counted once, that a voter must fire on
LABEL_FIRES = ((0.0, 0.05), (0.8, 1.0))  # what is believed of the label, in clean and toxic rows
TOGETHER = 250  # texts counted together before their features leave a task
CHANCE = 1e-3  # odds at most that a word without meaning meets so many toxic texts of its texts
NEAR = 4  # bits between the SimHashes of near copies
PAIRS = 256  # fingerprints compared with all others at a time
_WORD = re.compile(r"[^\W\d_]+")
PATTERNS = [  # ways of writing, each a voter of its own
    ("repeated exclamation", re.compile(r"[!?]{2,}")),
    ("shouting", re.compile(r"\b[A-ZÀ-ÖØ-Þ]{4,}\b")),
]


def _features(text):
    """Words of a text and their beginnings; a whole word is marked by a blank at its end."""
    found = set()
    for word in set(_WORD.findall(text.lower())):
        found.add(word + " ")
        found.update(word[:length] for length in BEGINNINGS if len(word) >= length)
    return found


def training_rows(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text",
                  sample=SAMPLE) -> DataFrame:
    """``text, toxic`` of labelled rows whose crc32 of the id modulo 5 is not 0.

    Null labels are left out; of several labels of an id the highest counts.
    """
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")
    ).filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select(
        F.col("doc_id").alias("_id"), "toxic"
    )
    # ``sample`` rows of an id and a label at most.
    return docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_id")
    ).groupBy("text").agg(F.max("toxic").alias("toxic"))  # copies say nothing new


def near_groups(values):
    """Number of the group of each fingerprint; those at most NEAR bits apart are linked."""
    values = np.asarray(values, np.uint64)
    group = np.full(len(values), -1, np.int64)
    rest, named = np.arange(len(values)), 0
    while len(rest):  # every value enters ``front`` once and meets all that have no group yet
        front, rest = rest[:1], rest[1:]
        while len(front):
            group[front] = named
            linked = np.zeros(len(rest), bool)
            for at in range(0, len(front), PAIRS):
                apart = np.bitwise_count(values[rest][:, None] ^ values[front[at:at + PAIRS]][None, :])
                linked |= (apart <= NEAR).any(axis=1)
            front, rest = rest[linked], rest[~linked]
        named += 1
    return group


def with_fingerprints(rows: DataFrame) -> DataFrame:
    """The training rows with the SimHash of their text."""

    def run(batches):
        for batch in batches:
            found = np.array(
                [simhash.fingerprint(text.as_py()) for text in batch["text"]], np.uint64
            ).view(np.int64)
            yield batch.append_column("fingerprint", pa.array(found))

    return rows.select("text", "toxic").mapInArrow(
        run, "text string, toxic int, fingerprint bigint"
    )


def copy_groups(rows: DataFrame) -> dict:
    """Group by fingerprint of the training rows that have near copies among them."""
    found = rows.groupBy("fingerprint").count().orderBy("fingerprint").collect()  # bounded by SAMPLE
    values = np.array([row["fingerprint"] for row in found], np.int64)
    names, members = near_groups(values.view(np.uint64)).tolist(), Counter()
    for name, row in zip(names, found):
        members[name] += row["count"]
    return {row["fingerprint"]: name for name, row in zip(names, found) if members[name] > 1}


def candidate_counts(rows: DataFrame) -> DataFrame:
    """``feature, toxic, clean``: documents of each class that have it, near copies of a class
    counted once; the empty feature is in all. Counted in the tasks, wherever the copies lie."""
    groups = copy_groups(rows)

    def counts(found, toxic, group=None):
        ones = pa.array(list(found.values()) if group is None else np.ones(len(found)), pa.int64())
        none = pa.array(np.zeros(len(found), np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array([group] * len(found), pa.int64()),
             *((ones, none) if toxic else (none, ones))],
            names=["feature", "copies", "toxic", "clean"],
        )

    def count(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                alone, copies = (Counter(), Counter()), {}
                for text, toxic, value in zip(part["text"], part["toxic"].to_pylist(),
                                              part["fingerprint"].to_pylist()):
                    toxic, group, found = bool(toxic), groups.get(value), _features(text.as_py())
                    found.add("")
                    if group is None:
                        alone[toxic].update(found)
                    else:
                        copies.setdefault((group, toxic), set()).update(found)
                for toxic, found in enumerate(alone):
                    yield counts(found, toxic)
                for (group, toxic), found in copies.items():
                    yield counts(found, toxic, group)

    def once(name):
        return F.when(F.col("copies").isNull(), F.sum(name)).otherwise(F.max(name)).alias(name)

    return rows.mapInArrow(
        count, "feature string, copies bigint, toxic bigint, clean bigint"
    ).groupBy("feature", "copies").agg(once("toxic"), once("clean")).groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )


def beyond_chance(toxic, clean, share):
    """If so many toxic texts are too many for a word that ``share`` of its texts make toxic.

    Chernoff's bound of the binomial tail, which is exact without clean texts.
    """
    texts = toxic + clean
    surprise = toxic * np.log(toxic / (texts * share))
    if clean:
        surprise += clean * np.log(clean / (texts * (1 - share)))
    return toxic > texts * share and surprise >= -np.log(CHANCE)


def choose_lexicon(rows: DataFrame):
    """Words and beginnings that speak for toxicity, none the beginning of another.

    All with SUPPORT, four toxic texts for each clean one, and more than chance would give;
    none of that depends on the number of texts or of other words.
    """
    ranked = candidate_counts(rows).filter(
        (F.col("feature") == "")
        | (F.col("toxic") >= SUPPORT) & (F.col("toxic") >= 4 * F.col("clean"))
    ).withColumn("_say", F.col("toxic") - 3 * F.col("clean")).orderBy(
        F.desc("_say"), F.length("feature"), "feature"
    ).collect()  # bounded by the words of SAMPLE texts
    share = next((row.toxic / (row.toxic + row.clean) for row in ranked if not row.feature), 0)
    chosen, begun = {}, set()
    for feature, toxic, clean, _ in ranked:
        if not feature or not beyond_chance(toxic, clean, share):
            continue
        own = [feature[:length] for length in range(1, len(feature) + 1)]
        if feature.strip() not in begun and not any(part in chosen for part in own):
            chosen[feature] = True
            begun.update(own)
    return list(chosen)


class Voters:
    """Which voters fire on a text, as the bits of an integer of any length."""

    def __init__(self, lexicon):
        self.lexicon = list(lexicon)
        self.bits = {name: 1 << at for at, name in enumerate(self.lexicon)}
        self.lengths = sorted({len(name) for name in self.lexicon if not name.endswith(" ")})
        self.patterns = [
            (1 << len(self.lexicon) + at, pattern) for at, (_, pattern) in enumerate(PATTERNS)
        ]
        self.count = len(self.lexicon) + len(PATTERNS)
        self.width = (self.count + 7) // 8

    def votes(self, text):
        mask, bits = 0, self.bits
        for word in set(_WORD.findall(text.lower())):
            mask |= bits.get(word + " ", 0)
            for length in self.lengths:
                mask |= bits.get(word[:length], 0)
        for bit, pattern in self.patterns:
            if pattern.search(text):
                mask |= bit
        return mask


def vote_counts(rows: DataFrame, voters: Voters):
    """(votes, label, rows) of the training rows; no more than there are rows."""

    def vote(batches):
        for batch in batches:
            found = [voters.votes(text.as_py()).to_bytes(voters.width, "little")
                     for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), batch["toxic"]], names=["votes", "toxic"]
            )

    counted = rows.mapInArrow(vote, "votes binary, toxic int").groupBy("votes", "toxic").agg(
        F.count(F.lit(1)).alias("rows")
    )
    return counted.orderBy("votes", "toxic").collect()  # bounded by SAMPLE


class LabelModel:
    """Two classes of documents, voters that fire in each at a rate of their own."""

    def __init__(self, votes, weights, labels, rounds=50):
        """``votes`` is a 0/1 matrix, ``weights`` the rows it stands for, ``labels`` 0/1."""
        votes = np.column_stack([votes, labels])  # the label is a voter too
        toxic = np.where(labels == 1, 0.9, 0.05)
        total = weights.sum()
        for _ in range(rounds):
            share = (weights * toxic).sum()
            self.prior = np.clip(share / total, 1e-6, 1 - 1e-6)
            self.fires = np.stack([
                ((weights * (1 - toxic)) @ votes + 0.05) / (total - share + 1),
                ((weights * toxic) @ votes + 0.5) / (share + 1),
            ])
            # Without a bound on the label, any two kinds of documents could be the classes.
            for at, (least, most) in enumerate(LABEL_FIRES):
                self.fires[at, -1] = np.clip(self.fires[at, -1], least, most)
            self.fires = np.clip(self.fires, 1e-5, 1 - 1e-5)
            self.say = self._discount(votes, weights, toxic)
            self.posterior = self.of(votes)
            if np.abs(self.posterior - toxic).max() < 1e-6:
                break
            toxic = self.posterior

    def _discount(self, votes, weights, toxic):
        """Say of each voter: one over the voters that it amounts to with its like.

        From the correlations within the classes, pooled, where they are clear.
        """
        pooled = np.zeros((votes.shape[1], votes.shape[1]))
        for share, rates in ((1 - toxic, self.fires[0]), (toxic, self.fires[1])):
            apart = votes - rates
            pooled += apart.T @ (apart * (weights * share)[:, None])
        scale = np.sqrt(np.maximum(np.diag(pooled), 1e-12))
        self.correlation = pooled / np.outer(scale, scale)
        np.fill_diagonal(self.correlation, 0.0)
        clear = np.where(self.correlation > 0.2, self.correlation, 0.0)
        clear[-1] = clear[:, -1] = 0.0  # the label is given apart from the voters
        return 1.0 / (1.0 + clear.sum(axis=1))

    def of(self, votes):
        """Posterior of the toxic class."""
        for_fire = np.log(self.fires[1] / self.fires[0])
        for_none = np.log((1 - self.fires[1]) / (1 - self.fires[0]))
        odds = np.log(self.prior / (1 - self.prior)) + (
            votes * (for_fire * self.say) + (1 - votes) * (for_none * self.say)
        ).sum(axis=1)
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30)))


def fit_linear(votes, weights, targets, penalty=0.1, steps=100):
    """Logistic regression on soft targets by damped Newton steps; weights, then the bias."""
    x = np.column_stack([votes, np.ones(len(votes))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    coefficients = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ coefficients, -30, 30)))
        gradient = x.T @ (weights * (targets - p)) - ridge * coefficients
        curvature = (x * (weights * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curvature, gradient)
        coefficients += step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return coefficients


class Scorer:
    """The trained classifier: voters, a weight each, and the bias."""

    def __init__(self, voters, coefficients):
        self.voters, self.coefficients, self.known = voters, coefficients, {}

    def score(self, text):
        mask = self.voters.votes(text)
        if mask not in self.known:
            if len(self.known) > 1 << 16:
                self.known.clear()
            odds = self.coefficients[-1] + sum(
                weight for at, weight in enumerate(self.coefficients[:-1]) if mask >> at & 1
            )
            self.known[mask] = float(1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30))))
        return self.known[mask]


def train(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text",
          sample=SAMPLE) -> Scorer:
    """Learn a scorer. Without labelled rows, or rows of one class only, it scores the share
    of toxic rows for every text, 0 if there are none."""
    rows = park(with_fingerprints(training_rows(docs, labels, doc_id, text, sample)), "labelled")
    voters = Voters(choose_lexicon(rows))
    counted = vote_counts(rows, voters)
    masks = np.frombuffer(b"".join(row.votes for row in counted), np.uint8)
    votes = np.unpackbits(
        masks.reshape(len(counted), voters.width), axis=1, count=voters.count, bitorder="little"
    ).astype(float)
    weights = np.array([row.rows for row in counted], float)
    labelled = np.array([row.toxic for row in counted], float)
    if not len(counted) or labelled.min() == labelled.max():
        share = labelled.mean() if len(counted) else 0.0
        return Scorer(voters, np.r_[np.zeros(voters.count), 30.0 if share else -30.0])
    model = LabelModel(votes, weights, labelled)
    return Scorer(voters, fit_linear(votes, weights, model.posterior))


def score_documents(docs: DataFrame, scorer: Scorer, carry=None, text="text") -> DataFrame:
    """The columns ``carry`` of ``docs``, all by default, in ``_doc``, with ``score`` (0 to 1) and ``predicted`` (score
    at least a half).

    A null text counts as empty, and an empty one has the score of a text on which no voter
    fires. Equal texts have equal scores, repeated rows are each scored, an empty table gives
    no rows. Columns of any name are carried along unread.
    """
    carried = list(carry or docs.columns)
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in carried]).alias("_doc"),
        *([] if text in carried else [F.col(f"`{text}`").alias("_text")]),
    )

    def run(batches):
        # A carried text is read where it is, and one text at a time is a Python string.
        for batch in batches:
            bodies = batch["_doc"].field(carried.index(text)) if text in carried else batch["_text"]
            scores = np.fromiter((scorer.score(body.as_py() or "") for body in bodies), float)
            yield pa.RecordBatch.from_arrays(
                [batch["_doc"], pa.array(scores, pa.float64())], names=["_doc", "score"]
            )

    schema = rows.select("_doc", F.lit(0.0).alias("score")).schema
    return rows.mapInArrow(run, schema).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
