"""Toxicity by weak supervision: many voters, a label model, a linear classifier.

Voters come from a list of insults and from words and beginnings of words that
set labelled toxic texts apart; each looks at how often its pattern occurs in a
text. Two patterns of form (shouting, runs of exclamation marks) vote as well. A
generative label model of all documents' votes, a tree of dependences between
voters under a hidden label, estimates how accurate each voter is and which
voters repeat one another. Its posterior labels train a linear classifier on the
frequency of every pattern, which scores the texts.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspace.llm.common import Sent, bounded_slices, columns_as, text_bytes, texts_of
from termspace.llm.labelled import labelled_sample
from termspace.session import remove, scratch_path, settle

# Bound of the labelled sample, for each label.
SAMPLE_ROWS = 1_500
SAMPLE_BYTES = 3 * 2**20
THRESHOLD = 0.5
# Patterns that the classifier weighs, and of them those that vote; votes of a text are the bits of a long.
PATTERNS, VOTERS = 240, 56
# Patterns tried for each that is taken.
TRIED = 10
# Lengths, in bytes, of the beginnings of words that are tried as patterns.
BEGINNINGS = range(3, 9)
# Shares of a text's words above which a pattern votes.
SHARES = (0.0, 0.002, 0.005, 0.01, 0.02, 0.05)
ROUNDS = 12
# What the votes on all texts weigh beside the labelled sample. More, and the hidden label may come to
# stand for something else that voters agree on, such as the language.
UNLABELLED = 0.25
SLICE = 2 * 2**20

# A seed list of insults, for when labels are few.
INSULTS = "asshole bastard bitch clown cretin disgusting dumbass idiot imbecile loser moron pathetic scum stupid trash worthless".split()

# A-Z to a-z, other ASCII but letters to space; the bytes of other characters stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_EDGE = " "
_CAPITALS, _LETTERS = string.ascii_uppercase.encode(), string.ascii_letters.encode()


def folded(data: bytes) -> str:
    """Words between single-byte marks, one character a byte, with a space at either end."""
    return f"{_EDGE}{data.translate(_FOLD).decode('latin-1')}{_EDGE}"


def form_votes(data: bytes) -> tuple[bool, bool]:
    """Whether most ASCII letters of a text are capitals, and whether exclamation marks come in runs."""
    capitals, letters = (len(data) - len(data.translate(None, kind)) for kind in (_CAPITALS, _LETTERS))
    return letters >= 12 and capitals * 2 > letters, b"!!!" in data


class Matcher:
    """Counts patterns in folded texts: " word " for a word, " begin" for the beginning of one."""

    def __init__(self, patterns: list[str]):
        self._automaton = ahocorasick.Automaton()
        for i, pattern in enumerate(patterns):
            self._automaton.add_word(pattern, i)
        if patterns:
            self._automaton.make_automaton()
        self.patterns = patterns

    def counts(self, text: str) -> dict[int, int]:
        if not self.patterns:
            return {}
        found: dict[int, int] = {}
        for _, i in self._automaton.iter(text):
            found[i] = found.get(i, 0) + 1
        return found


def word_count(text: str) -> int:
    return len(text.split())


@dataclass
class LabelModel:
    """P(label) and, for each voter, P(vote | label, vote of its parent); parents make a tree, -1 is none."""

    prior: float
    parent: list[int]
    chance: np.ndarray  # voter, label, parent's vote -> chance of a vote

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        found = np.full(len(votes), np.log(self.prior) - np.log1p(-self.prior))
        for j, parent in enumerate(self.parent):
            given = votes[:, parent].astype(int) if parent >= 0 else np.zeros(len(votes), int)
            one, zero = self.chance[j, 1][given], self.chance[j, 0][given]
            found += np.where(votes[:, j], np.log(one) - np.log(zero), np.log1p(-one) - np.log1p(-zero))
        return found

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(votes), -30, 30)))

    def accuracies(self) -> np.ndarray:
        """Chance of a vote under either label, whatever the parent says; rows are voters."""
        found = np.zeros((len(self.parent), 2))
        for j in self._downwards():
            up = self.parent[j]
            share = found[up] if up >= 0 else np.zeros(2)
            found[j] = self.chance[j, [0, 1], 0] * (1 - share) + self.chance[j, [0, 1], 1] * share
        return found

    def _downwards(self) -> list[int]:
        order: list[int] = []
        while len(order) < len(self.parent):
            order += [j for j, up in enumerate(self.parent) if j not in order and (up < 0 or up in order)]
        return order


@dataclass
class ToxicityModel:
    patterns: list[str]
    voters: list[tuple[int, float]]  # (pattern, share above which it votes); -1 and -2 are the votes of form
    labels: LabelModel | None
    weights: np.ndarray
    offset: float

    def votes_of(self, counts: dict[int, int], words: int, form: tuple[bool, bool]) -> list[bool]:
        limit = max(words, 1)
        return [form[-p - 1] if p < 0 else counts.get(p, 0) > share * limit for p, share in self.voters]

    def features(self, counts: dict[int, int], words: int) -> np.ndarray:
        """For each pattern whether it occurs, and how densely, up to one word in twenty."""
        found = np.zeros(2 * len(self.patterns))
        for i, n in counts.items():
            found[2 * i] = 1.0
            found[2 * i + 1] = min(1.0, 20.0 * n / max(words, 1))
        return found

    def score(self, counts: dict[int, int], words: int) -> float:
        total = self.offset
        for i, n in counts.items():
            total += self.weights[2 * i] + self.weights[2 * i + 1] * min(1.0, 20.0 * n / max(words, 1))
        return 1 / (1 + np.exp(-min(30.0, max(-30.0, total))))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
    work: str | None = None,
) -> ToxicityModel:
    """A model from (label_id, label 0 or 1) of the rows of ``docs``.

    Patterns, and the classifier, come from at most ``sample_rows`` whole texts
    and ``sample_bytes`` bytes per label; the label model from the votes on all
    texts, of which only how often each set of votes occurs is kept. Null labels
    and ids and empty texts teach nothing; a text labelled both ways counts for
    both; repeated rows vote each. With less than two labels scores are constant,
    without any a half. Columns that are not named do not matter.
    """
    spark = docs.sparkSession
    work = work or scratch_path(spark, "toxicity")
    texts = columns_as(docs, _id=doc_id, _text=text)
    marks = columns_as(labels, _id=label_id, _label=label).filter("_label IN (0, 1)")
    rows = labelled_sample(texts, marks, sample_rows, sample_bytes, f"{work}/sample")
    y = np.array([r[0] for r in rows], float)
    if len(set(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return ToxicityModel([], [], None, np.zeros(0), float(np.log(share / (1 - share))))
    # Labels weigh as they occur, not as they were sampled.
    known = {r["_label"]: r["count"] for r in marks.dropna().distinct().groupBy("_label").count().collect()}
    weight = np.where(y == 1, known[1] / (y == 1).sum(), known[0] / (y == 0).sum())
    weight *= len(y) / weight.sum()
    data = [r[2].encode() for r in rows]
    sample = [folded(d) for d in data]
    patterns = choose_patterns(sample, y)
    matcher = Matcher(patterns)
    counted = [(matcher.counts(t), word_count(t), form_votes(d)) for t, d in zip(sample, data)]
    model = ToxicityModel(patterns, choose_voters(counted, patterns, y), None, np.zeros(2 * len(patterns)), 0.0)
    votes = np.array([model.votes_of(*c) for c in counted], bool)
    table = settle(vote_sets(texts, model), "votes", work)
    model.labels = fit_label_model(table, votes, y, weight)
    remove(spark, work)
    x = np.array([model.features(c, n) for c, n, _ in counted])
    model.weights, model.offset = linear_classifier(x, model.labels.posterior(votes), weight)
    return model


def choose_patterns(sample: list[str], y: np.ndarray, most: int = PATTERNS) -> list[str]:
    """The listed insults, and words and beginnings that toxic texts have more often than others.

    Taken one by one by how much they tell about texts that few chosen ones have
    yet found, so that insults of a small language find a place beside those of
    a large one. Of patterns that find the same texts the shortest is taken.
    """
    good, bad = int((y == 0).sum()), int((y == 1).sum())
    words = [set(text.split()) for text in sample]
    hits: dict[str, list[int]] = {}
    toxic = np.flatnonzero(y == 1)
    for row, i in enumerate(toxic):
        for pattern in _patterns_of(words[i]):
            hits.setdefault(pattern, []).append(row)
    hits = {pattern: rows for pattern, rows in hits.items() if len(rows) > 1}
    misses = dict.fromkeys(hits, 0)
    for i in np.flatnonzero(y == 0):
        for pattern in _patterns_of(words[i]) & hits.keys():
            misses[pattern] += 1
    scored = []
    for pattern, rows in hits.items():
        # At least twice as frequent among toxic texts.
        if len(rows) * good > 2 * (misses[pattern] + 0.5) * bad:
            gain = np.log((len(rows) + 0.5) / (bad + 1)) - np.log((misses[pattern] + 0.5) / (good + 1))
            scored.append((gain * len(rows), pattern, gain))
    scored.sort(key=lambda s: (-s[0], len(s[1]), s[1]))
    chosen = [f"{_EDGE}{w}{_EDGE}" for w in INSULTS]
    left, seen = [], set(chosen)
    for _, pattern, gain in scored:
        if pattern not in seen and (same := tuple(hits[pattern])) not in seen:
            seen.add(same)
            left.append((pattern, gain))
        if len(left) == TRIED * most:
            break
    found = np.zeros((len(left), bad), np.float32)
    for row, (pattern, gain) in enumerate(left):
        found[row, hits[pattern]] = gain
    open_to = np.ones(bad, np.float32)
    for _ in range(min(len(left), most - len(chosen))):
        best = int((found @ open_to).argmax())
        chosen.append(left[best][0])
        open_to[found[best] > 0] *= 0.8
        found[best] = 0
    return chosen


def _patterns_of(words: set[str]) -> set[str]:
    found = {f"{_EDGE}{w}{_EDGE}" for w in words if len(w) > 2}
    return found | {_EDGE + w[:n] for n in BEGINNINGS for w in words if len(w) > n}


def choose_voters(counted: list, patterns: list[str], y: np.ndarray, most: int = VOTERS) -> list[tuple[int, float]]:
    """The first patterns, each with the share of words that tells most, and the votes of form."""
    words = np.array([max(n, 1) for _, n, _ in counted])
    voters: list[tuple[int, float]] = [(-1, 0.0), (-2, 0.0)]
    order = [*range(len(INSULTS), len(patterns)), *range(len(INSULTS))]
    for p in order[: most - 2]:
        share = np.array([c.get(p, 0) for c, _, _ in counted]) / words
        told = [_information(share > least, y) for least in SHARES]
        voters.append((p, SHARES[int(np.argmax(told))]))
    return voters


def _information(vote: np.ndarray, y: np.ndarray) -> float:
    """Mutual information of a vote and the label."""
    found = 0.0
    for v in (False, True):
        for k in (0, 1):
            joint = ((vote == v) & (y == k)).mean()
            if joint:
                found += joint * np.log(joint / ((vote == v).mean() * (y == k).mean()))
    return found


def vote_sets(texts: DataFrame, model: ToxicityModel) -> DataFrame:
    """(votes, n): how many texts got each set of votes, a bit per voter; null and empty texts get none."""
    sent = Sent(texts.sparkSession, model)

    @F.arrow_udf("long")
    def votes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.get()
        matcher = Matcher(model.patterns)
        for batch in batches:
            found = np.zeros(len(batch), np.int64)
            for i, data in _each(batch):
                text = folded(data)
                cast = model.votes_of(matcher.counts(text), word_count(text), form_votes(data))
                found[i] = sum(1 << j for j, vote in enumerate(cast) if vote)
            yield pa.array(found)

    return texts.select(votes(F.col("_text")).alias("votes")).groupBy("votes").agg(F.count("*").alias("n"))


def _each(batch: pa.Array) -> Iterator[tuple[int, bytes]]:
    data, offsets = text_bytes(texts_of(batch))
    for first, last in bounded_slices(offsets, SLICE):
        for i in range(first, last):
            yield i, data[offsets[i] : offsets[i + 1]].tobytes()


def unpacked(votes: np.ndarray, voters: int) -> np.ndarray:
    return (votes[:, None] >> np.arange(voters)) & 1 == 1


def fit_label_model(table: DataFrame, votes: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over all sets of votes.

    The first estimate, and a prior that keeps the hidden label the labelled
    one, come from the sample; the votes on all texts together weigh
    ``UNLABELLED`` of it. Dependences are the tree of largest mutual
    information of two votes under the hidden label; it is drawn from the first
    expectation over all texts and then kept, so every round raises the likelihood.
    """
    voters = votes.shape[1]
    anchor = _moments(votes, np.stack([weight * (y == 0), weight * (y == 1)]))
    model = _maximised(anchor, [-1] * voters)
    parent = None
    for _ in range(rounds):
        expected = _expected(table, model, voters)
        moments = anchor + expected * (UNLABELLED * anchor[:, 0, 0].sum() / max(expected[:, 0, 0].sum(), 1))
        if parent is None:
            parent = dependence_tree(moments)
        before, model = model, _maximised(moments, parent)
        if before.parent == parent and np.abs(before.chance - model.chance).max() < 1e-6:
            break
    return model


def _moments(votes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each label the weighted counts of pairs of votes, with a column of ones before them."""
    full = np.concatenate([np.ones((len(votes), 1)), votes], axis=1)
    return np.stack([(full * w[:, None]).T @ full for w in weights])


def _expected(table: DataFrame, model: LabelModel, voters: int) -> np.ndarray:
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, voters + 1, voters + 1))
        for batch in batches:
            votes = unpacked(batch["votes"].to_numpy(), voters)
            toxic, n = model.posterior(votes), batch["n"].to_numpy()
            total += _moments(votes, np.stack([n * (1 - toxic), n * toxic]))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"place": pa.array(used, pa.int32()), "value": total.ravel()[used]})

    # At most one row per label and pair of voters comes back.
    sums = table.mapInArrow(local, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    found = np.zeros(2 * (voters + 1) ** 2)
    for row in sums:
        found[row["place"]] = row["value"]
    return found.reshape(2, voters + 1, voters + 1)


def _pair_table(moments: np.ndarray, i: int, j: int) -> np.ndarray:
    """label, vote of i, vote of j -> count."""
    both, one, two, whole = moments[:, i + 1, j + 1], moments[:, 0, i + 1], moments[:, 0, j + 1], moments[:, 0, 0]
    return np.stack([np.stack([whole - one - two + both, two - both], 1), np.stack([one - both, both], 1)], 1)


def dependence_tree(moments: np.ndarray) -> list[int]:
    """Parent of every voter in the tree of largest conditional mutual information (-1 for the first)."""
    voters = moments.shape[1] - 1
    told = np.zeros((voters, voters))
    for i in range(voters):
        for j in range(i):
            p = np.maximum(_pair_table(moments, i, j), 0) + 0.1
            p /= p.sum()
            of_i, of_j, label = p.sum(axis=2, keepdims=True), p.sum(axis=1, keepdims=True), p.sum(axis=(1, 2), keepdims=True)
            told[i, j] = told[j, i] = (p * np.log(p * label / (of_i * of_j))).sum()
    parent, best, reached = [-1] * voters, told[0].copy(), {0}
    nearest = [0] * voters
    while len(reached) < voters:
        j = max((j for j in range(voters) if j not in reached), key=lambda j: best[j])
        parent[j] = nearest[j]
        reached.add(j)
        for i in range(voters):
            if i not in reached and told[j, i] > best[i]:
                best[i], nearest[i] = told[j, i], j
    return parent


def _maximised(moments: np.ndarray, parent: list[int]) -> LabelModel:
    whole = moments[:, 0, 0]
    chance = np.zeros((len(parent), 2, 2))
    for j, up in enumerate(parent):
        marginal = (moments[:, 0, j + 1] + 0.5) / (whole + 1)
        if up < 0:
            chance[j] = marginal[:, None]
        else:
            # Rarely seen votes of the parent leave the voter near its own rate.
            pair = np.maximum(_pair_table(moments, up, j), 0)
            chance[j] = (pair[:, :, 1] + 2 * marginal[:, None]) / (pair.sum(axis=2) + 2)
    return LabelModel(float((whole[1] + 1) / (whole.sum() + 2)), parent, np.clip(chance, 1e-6, 1 - 1e-6))


def linear_classifier(x: np.ndarray, p: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic model of soft labels, by Newton steps; the ridge keeps them finite."""
    design = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    prior = np.diag([ridge] * x.shape[1] + [1e-6])
    beta = np.zeros(design.shape[1])
    beta[-1] = np.log((p @ weight + 1) / ((1 - p) @ weight + 1))

    def loss(b: np.ndarray) -> float:
        z = design @ b
        return float(weight @ (np.logaddexp(0, z) - p * z) + b @ prior @ b / 2)

    for _ in range(60):
        q = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (p - q)) - prior @ beta
        hessian = (design * (weight * np.maximum(q * (1 - q), 1e-6))[:, None]).T @ design + prior
        step, size, now = np.linalg.solve(hessian, gradient), 1.0, loss(beta)
        while size > 1e-6 and loss(beta + size * step) > now:
            size /= 2
        beta += size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return beta[:-1], float(beta[-1])


def toxicity_score(model: ToxicityModel, docs: DataFrame, text: str):
    """Score column (0 to 1) of a text column, read whole; null and empty texts get the score of no pattern."""
    sent = Sent(docs.sparkSession, model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.get()
        matcher = Matcher(model.patterns)
        for batch in batches:
            found = np.zeros(len(batch))
            for i, data in _each(batch):
                text = folded(data)
                counts = matcher.counts(text)
                found[i] = model.score(counts, word_count(text) if counts else 0)
            yield pa.array(found)

    return score(F.col(text))
