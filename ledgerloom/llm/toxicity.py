"""Toxicity: a support vector machine over a gap-weighted subsequence string kernel.

A text falls into sentences, these into words stripped to letters and digits (runs of single
characters, "i d i o t", are drawn together), and words into overlapping windows of
``WINDOW`` characters; the first carries a mark for the start of the word. The kernel of two
windows sums their common subsequences of ``ORDER`` characters, each gap weighing ``LAMBDA``
a character, and is normalised, so inserted characters lower it only a little. The kernel
values with some landmarks give Nyström features; a linear machine on them scores windows.
A sentence scores as its highest window, a text as its highest sentence.

Learning: labels are of documents, and a sentence has that of its document. Word beginnings
that are in far more toxic than other sentences (a sentence counts once, so copies do not
count) become landmarks; common beginnings of other documents join them. In toxic documents the sentences with such a
beginning are the witnesses: the windows of these words are positive examples, as are the
landmarks and copies of them with inserted characters. All windows of other documents are
negative, the ones closest to the landmarks are kept. Fitted on the driver to
about ``SAMPLE_PER_LABEL`` documents a label of at most ``FIT_BYTES`` bytes, chosen by a
hash of the id.

Every whole text is then scored in one pass, unshuffled. Words and windows are remembered
per task (``MEMO_BYTES`` of words, ``MEMO_WINDOWS``), which only saves work. Defined cases: null and
empty texts score as a text without words; with no toxic sample every score is 0; repeated
rows are scored each.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .text import as_rows, labelled_sample, remainder, row_pieces

ORDER, LAMBDA = 4, 0.7
WINDOW, START = 8, "^"
MOST_LANDMARKS, OTHER_LANDMARKS, COVERED = 256, 4, 0.05
"""Landmarks at most, and the share of a typical beginning's kernel that may lie outside their span."""
LEAST_SENTENCES, LEAST_RATIO, FALSE_FINDS = 3, 8.0, 1e-6
"""A word beginning is typical if it is in so many toxic sentences, at so many times the rate of others, and not by chance."""
HARD_NEGATIVES, NEGATIVE_WEIGHT = 4_000, 5.0
SAMPLE_PER_LABEL, FIT_BYTES = 1_500, 20_000
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
LOWEST = -1e6
"""The decision of a text without windows: below every other."""
MEMO_BYTES, MEMO_WINDOWS = 2_000_000, 300_000
_LANES, _PAIR_LANES = 8192, 16384
_SENTENCE_END = regex.compile(r"[.!?]+(?=\s|$)|\n+")
_NO_CONTENT = regex.compile(r"[^\p{L}\p{N}]+")


def raw_words(text: str) -> list[str]:
    """Words as they stand, and runs of three or more single characters as one word each."""
    words = text.lower().split()
    single = np.flatnonzero(np.fromiter(map(len, words), np.int64, len(words)) == 1)
    if len(single) > 2:
        runs = np.split(single, np.flatnonzero(np.diff(single) > 1) + 1)
        words += ["".join(words[run[0] : run[-1] + 1]) for run in runs if len(run) > 2]
    return words


def stripped(unit: str) -> str:
    """Letters and digits only, accents composed."""
    return _NO_CONTENT.sub("", unit if unit.isascii() else unicodedata.normalize("NFC", unit))


def windows(word: str) -> list[str]:
    """Overlapping windows, the first with the start mark; nothing if the word is too short for the kernel."""
    if len(word) < ORDER - 1:
        return []
    step = WINDOW // 2
    return [START + word[:WINDOW], *[word[at : at + WINDOW] for at in range(step, len(word) - step, step)]]


def _codes(units: list[str], length: int) -> np.ndarray:
    """Code points, a column for each unit, filled up with 0."""
    return np.array([[*map(ord, u), *[0] * (length - len(u))] for u in units], dtype=np.uint32).reshape(len(units), length).T


def _dynamic(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Kernel sums of the pairs of columns of ``left`` and ``right``, letters by row."""
    shape = left.shape[1:]
    span = len(right)
    total = np.zeros(shape, np.float32)
    partial = np.zeros((ORDER, span + 1, *shape), np.float32)
    partial[0] = 1
    decay, weight = np.float32(LAMBDA), np.float32(LAMBDA * LAMBDA)
    for letter in left:
        same = (right == letter) & (right > 0)
        used = [j for j in range(span) if same[j].any()]
        match = {j: np.where(same[j], weight, np.float32(0)) for j in used}
        for j in used:
            total += match[j] * partial[ORDER - 1, j]
        for order in range(ORDER - 1, 0, -1):
            carry = None
            for j in range(span):
                if carry is not None:
                    carry *= decay
                if j in match:
                    gain = match[j] * partial[order - 1, j]
                    carry = gain if carry is None else carry + gain
                partial[order, j + 1] *= decay
                if carry is not None:
                    partial[order, j + 1] += carry
    return total


def _letter_planes(units: list[str]) -> np.ndarray:
    """Per unit the letters (folded into 64) that it has at least once, twice, three and four times."""
    planes = np.zeros((len(units), ORDER), np.uint64)
    if units:
        codes = _codes(units, max(map(len, units)))
        place = np.where(codes > 0, codes % 64, 64).astype(np.int64)
        counts = np.zeros((len(units), 65), np.int64)
        for row in place:
            counts[np.arange(len(units)), row] += 1
        for times in range(ORDER):
            planes[:, times] = ((counts[:, :64] > times).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return planes


def _may_share(units: list[str], landmarks: list[str]) -> np.ndarray:
    """Pairs with ``ORDER`` letters in common, in whatever order; the kernel of all others is zero."""
    left, right = _letter_planes(units), _letter_planes(landmarks)
    common = np.zeros((len(units), len(landmarks)), np.uint8)
    for times in range(ORDER):
        common += np.bitwise_count(left[:, None, times] & right[None, :, times])
    return common >= ORDER


def kernel(units: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel values, a row for each unit. Only pairs that may share a subsequence are worked out."""
    out = np.zeros((len(units), len(landmarks)), np.float32)
    if not units or not landmarks:
        return out
    theirs = _codes(landmarks, max(map(len, landmarks)))
    norms = np.array([_dynamic(c[:, None], c[:, None])[0] for c in (_codes([t], len(t))[:, 0] for t in landmarks)])
    sizes = np.array([len(u) for u in units])
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        if size < ORDER:
            continue
        for low in range(0, len(own), _LANES):
            some = own[low : low + _LANES]
            names = [units[i] for i in some]
            codes = _codes(names, int(size))
            row, column = np.nonzero(_may_share(names, landmarks))
            values = np.zeros(len(row), np.float32)
            for at in range(0, len(row), _PAIR_LANES):
                part = slice(at, at + _PAIR_LANES)
                values[part] = _dynamic(codes[:, row[part]], theirs[:, column[part]])
            self_value = _dynamic(codes, codes)
            out[some[row], column] = values / np.sqrt(np.maximum(norms[column] * self_value[row], 1e-30))
    return out


class Machine:
    """Landmarks, weights over the kernel with them, and the calibration to a probability."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.weights = np.zeros(len(landmarks))
        self.bias, self.slope, self.offset = -1.0, 1.0, 0.0

    def decisions(self, windows_: list[str]) -> np.ndarray:
        """Distances from the boundary."""
        return kernel(windows_, self.landmarks) @ self.weights + self.bias

    def probability(self, decisions: np.ndarray) -> np.ndarray:
        if not self.landmarks:
            return np.zeros(len(decisions))
        return 1 / (1 + np.exp(-np.clip(self.slope * decisions + self.offset, -30, 30)))


def _with_insertions(window: str) -> list[str]:
    """Copies of a window with one and two characters put in."""
    fill = "xqz"
    once = [window[:at] + fill[at % 3] + window[at:] for at in range(2, len(window))]
    twice = [window[:at] + fill[at % 3] + window[at : at + 2] + fill[(at + 1) % 3] + window[at + 2 :] for at in range(2, len(window) - 2)]
    return [w[: WINDOW + 1] for w in once + twice]


def _support_vectors(features: np.ndarray, labels: np.ndarray, weights: np.ndarray, penalty: float = 20.0, steps: int = 400) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by accelerated gradient descent."""
    sign = np.where(labels > 0, 1.0, -1.0)
    data = np.concatenate((features, np.ones((len(features), 1))), axis=1)
    ridge = np.full(data.shape[1], 1.0)
    ridge[-1] = 1e-3
    share = penalty * weights
    rate = 1 / (2 * np.linalg.norm(data.T * share @ data, 2) + 1)
    now = ahead = np.zeros(data.shape[1])
    for step in range(steps):
        slack = np.maximum(1 - sign * (data @ ahead), 0)
        grad = ridge * ahead - 2 * data.T @ (share * sign * slack)
        then = ahead - rate * grad
        ahead = then + step / (step + 3) * (then - now)
        now = then
    return now[:-1], float(now[-1])


def _beginnings(word: str) -> list[str]:
    return [START + word[:size] for size in range(ORDER, min(len(word), WINDOW) + 1)]


def _document_counts(documents: list[list[list[str]]], known: set[str] | None = None) -> Counter:
    """In how many documents each word beginning is; with ``known`` only of these and of the shortest ones."""
    count: Counter = Counter()
    for parts in documents:
        found = {p for word in {w for s in parts for w in s} for p in _beginnings(word)}
        count.update(found if known is None else {p for p in found if len(p) == ORDER + 1 or p in known})
    return count


def _in_context(documents: list[list[list[str]]], counts: Counter, wanted: set[str]) -> tuple[dict[str, int], int]:
    """How often the wanted beginnings occur: once a document at most, and once for each word before or after (whichever are
    more), so that near copies of one text count little. And the number of different sentences."""
    before, after, seen = {p: set() for p in wanted}, {p: set() for p in wanted}, set()
    for parts in documents:
        for sentence in {tuple(s) for s in parts} - seen:
            seen.add(sentence)
            for left, word, right in zip(("", *sentence), sentence, (*sentence[1:], "")):
                for p in _beginnings(word):
                    if p in wanted:
                        before[p].add(left)
                        after[p].add(right)
    return {p: min(counts[p], max(len(before[p]), len(after[p]))) for p in wanted}, len(seen)


def typical_beginnings(toxic: list[list[list[str]]], other: list[list[list[str]]]) -> tuple[list[str], list[str]]:
    """Word beginnings typical of toxic documents, and the commonest of the others. Documents are lists of sentences, these of words.

    Typical is what occurs often enough, at many times the rate of other documents, and so
    often that among all beginnings less than ``FALSE_FINDS`` would do so by chance.
    """
    in_toxic = _document_counts(toxic)
    tried = len(in_toxic)
    in_toxic = Counter({p: n for p, n in in_toxic.items() if n >= LEAST_SENTENCES})
    in_other = _document_counts(other, set(in_toxic))
    wanted = {p for p, n in in_toxic.items() if n * max(1, len(other)) >= LEAST_RATIO / 4 * in_other[p] * max(1, len(toxic))}
    (times, n_toxic), (others, n_other) = _in_context(toxic, in_toxic, wanted), _in_context(other, in_other, wanted)
    share = max(1, n_toxic) / max(1, n_other)
    expected = {p: (others[p] + 0.5) * share for p in wanted}
    surprise = {p: n * np.log(n / expected[p]) - (n - expected[p]) for p, n in times.items() if n >= LEAST_SENTENCES and n >= LEAST_RATIO * expected[p]}
    least = np.log(max(1, tried) / FALSE_FINDS)
    typical: list[str] = []
    # Of beginnings that continue one another the most surprising stands for all, the longer one in a tie.
    for p in sorted((p for p, x in surprise.items() if x >= least), key=lambda p: (-surprise[p], -len(p), p)):
        if not any(p.startswith(c) or c.startswith(p) for c in typical):
            typical.append(p)
    common = [p for p, n in sorted(in_other.items(), key=lambda x: (-x[1], x[0])) if in_toxic[p] * len(other) <= 2 * n * len(toxic)]
    return typical, common[:OTHER_LANDMARKS]


def spanning(units: list[str], most: int = MOST_LANDMARKS, least: float = COVERED) -> list[str]:
    """Units whose features span those of all others up to ``least``: pivoted Cholesky on the kernel, the strongest first."""
    if not units:
        return []
    rest, factor, chosen = np.ones(len(units)), np.zeros((len(units), 0)), []
    while len(chosen) < most:
        pivot = int(np.argmax(rest))
        if rest[pivot] <= least:
            break
        column = (kernel(units, [units[pivot]])[:, 0] - factor @ factor[pivot]) / np.sqrt(rest[pivot])
        factor = np.column_stack((factor, column))
        rest = np.maximum(rest - column * column, 0)
        rest[pivot] = 0
        chosen.append(units[pivot])
    return chosen


def fit(texts: list[str], labels: np.ndarray) -> Machine:
    """Choose landmarks and fit the machine to labelled texts."""
    labels = np.asarray(labels)
    once: dict[str, str] = {}  # equal words are one object
    sentences = [[[once.setdefault(w, w) for w in map(stripped, raw_words(part)) if len(w) >= ORDER - 1] for part in _SENTENCE_END.split(t)] for t in texts]
    toxic = [parts for parts, label in zip(sentences, labels) if label == 1]
    other = [parts for parts, label in zip(sentences, labels) if label == 0]
    marks, common = typical_beginnings(toxic, other)
    if not marks or not other:
        return Machine([])
    machine = Machine(spanning(marks) + common)
    inverse_root = _inverse_root(kernel(machine.landmarks, machine.landmarks).astype(float))
    negatives = sorted({w for parts in other for s in parts for word in s for w in windows(word)})
    near = kernel(negatives, machine.landmarks)
    hard = near[np.argsort(-near[:, : -len(common) or None].max(axis=1), kind="stable")[:HARD_NEGATIVES]].astype(float)
    typical = set(marks)
    witnesses = {windows(word)[0] for parts in toxic for s in parts for word in s if not typical.isdisjoint(_beginnings(word))}
    positives = sorted(witnesses) + [v for p in marks for v in [p, *_with_insertions(p)]]
    positive = kernel(positives, machine.landmarks).astype(float)
    features = np.concatenate((positive, hard)) @ inverse_root
    sizes = [len(positive), len(hard)]
    share = np.repeat([1 / sizes[0], NEGATIVE_WEIGHT / max(1, sizes[1])], sizes) * sum(sizes) / 2
    weights, bias = _support_vectors(features, np.repeat([1, 0], sizes), share)
    machine.weights, machine.bias = inverse_root @ weights, bias
    scorer = Scorer(machine)
    highest = [np.sort(scorer.decide([t for t, label in zip(texts, labels) if label == which])) for which in (0, 1)]
    _calibrate(machine, *highest)
    return machine


def _calibrate(machine: Machine, clean: np.ndarray, toxic: np.ndarray) -> None:
    """Place the threshold's probability where few clean and many toxic documents of the sample are above it.

    A clean document above counts as ``NEGATIVE_WEIGHT`` toxic ones below. Between two
    neighbouring values the cut lies a third up.
    """
    edges = np.unique(np.concatenate((clean, toxic)))
    below_clean, below_toxic = np.searchsorted(clean, edges, side="right") / len(clean), np.searchsorted(toxic, edges, side="right") / len(toxic)
    cost = NEGATIVE_WEIGHT * (1 - below_clean) + below_toxic
    best = np.flatnonzero(cost == cost.min())
    gaps = np.append(np.diff(edges), 1.0)
    at = best[np.argmax(gaps[best])]
    cut = edges[at] + gaps[at] / 3
    machine.slope = 4.0
    machine.offset = float(np.log(THRESHOLD / (1 - THRESHOLD))) - machine.slope * cut


def _inverse_root(gram: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh(gram)
    keep = values > 1e-6
    return vectors[:, keep] / np.sqrt(values[keep])


class _Numbers(dict):
    """Numbers units in the order they are first met."""

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        return number


class Scorer:
    """Scores texts with a memory of words and windows; results do not depend on what it remembers."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.words, self.highest, self.bytes = _Numbers(), np.zeros(0), 0
        self.windows, self.decisions = _Numbers(), np.zeros(0)

    def _learn_words(self) -> None:
        """Decisions of the words met since the last call."""
        new_words = list(islice(self.words, len(self.highest), None))
        self.bytes += sum(map(len, new_words))
        cut = [windows(stripped(w)) for w in new_words]
        if len(self.windows) > MEMO_WINDOWS:
            self.windows, self.decisions = _Numbers(), np.zeros(0)
        places = np.fromiter((self.windows[w] for ws in cut for w in ws), np.int64)
        new = list(islice(self.windows, len(self.decisions), None))
        self.decisions = np.concatenate((self.decisions, self.machine.decisions(new)))
        highest = np.full(len(cut), LOWEST)
        np.maximum.at(highest, np.repeat(np.arange(len(cut)), [len(ws) for ws in cut]), self.decisions[places])
        self.highest = np.concatenate((self.highest, highest))

    def decide(self, texts: list[str]) -> np.ndarray:
        """The highest decision of each text's windows; ``LOWEST`` for a text without any."""
        if self.bytes > MEMO_BYTES:
            self.words, self.highest, self.bytes = _Numbers(), np.zeros(0), 0
        places = [np.fromiter(map(self.words.__getitem__, raw_words(t)), np.int64) for t in texts]
        self._learn_words()
        return np.array([self.highest[p].max() if len(p) else LOWEST for p in places])

    def score(self, texts: list[str]) -> np.ndarray:
        return self.machine.probability(self.decide(texts))


def learn_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", per_label: int = SAMPLE_PER_LABEL) -> Machine:
    """Fit a machine to a bounded sample of the labelled documents given."""
    rows = labelled_sample(docs, labels, label, doc_id, text, per_label, FIT_BYTES).toPandas().sort_values(["label", "_id", "text"])
    return fit(rows["text"].tolist(), rows["label"].to_numpy())


def score_toxicity(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """``row`` (the document as it came) and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    rows = as_rows(docs)

    def score(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            for piece, texts in row_pieces(batch, text):
                scores = scorer.score(texts.to_pylist())
                yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(scores, pa.float64())], ["row", "score"])

    return rows.mapInArrow(score, rows.select("row", F.lit(0.0).alias("score")).schema)


def remove_toxic(docs: DataFrame, machine: Machine, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more, with the columns they came with."""
    return score_toxicity(docs, machine, text).where(F.col("score") < threshold).select("row.*")


def toxicity_report(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from labels that are not held out, then score every document."""
    machine = learn_toxicity(docs, labels.where(remainder(doc_id, FOLDS) != HELD_OUT), doc_id, text)
    scored = score_toxicity(docs.select(doc_id, text), machine, text).select(F.col(f"row.{doc_id}").alias(doc_id), "score")
    return scored.select(doc_id, (remainder(doc_id, FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
