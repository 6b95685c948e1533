"""Toxicity (operator 5): a classifier that is regularised by counterfactual texts.

A text is the set of its words and of their beginnings, hashed. Counts over labelled texts choose the features that go
with either label, and a logistic regression weighs them. For labelled texts that mention a group of people, the
mentions are swapped for those of another group, and the squared change of the score is a penalty, so that
naming a group does not count by itself.

Fitting uses at most ``train_rows`` labelled texts, taken by a hash of their ids; its counts have a fixed size and are
added up in a tree, and only texts reduced to chosen features come to the driver. Scoring covers every row.

A missing text counts as empty; it has no features and gets the score of the intercept. Ids may repeat or be
missing: each row gets a row; a document with several labels counts as toxic if one of them says so. Without
labelled texts of both kinds, all scores are the share of toxic ones (0 if there are none). An empty table gives no
rows; only id and text are read, and no other column has a part in a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, row_keys, tree_sum

TRAIN_ROWS = 20_000
FEATURE_BITS = 22
MOST_FEATURES = 20_000
LEAST_TEXTS = 5
LEAST_Z = 4.0
PENALTY = 1.0
L2 = 1e-5
STEPS = 600
CACHED = 150_000

# Groups of words that name people; each word is swapped for the next one of its group.
IDENTITIES = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("gay", "lesbian", "straight", "bisexual"),
    ("transgender", "cisgender"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("black", "white", "asian", "latino"),
    ("african", "european", "american", "arab", "mexican", "chinese", "indian"), ("immigrant", "refugee", "citizen"),
    ("immigrants", "refugees", "citizens"), ("disabled", "blind", "deaf"), ("old", "young"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)
SWAPS = {word: group[(i + 1) % len(group)] for group in IDENTITIES for i, word in enumerate(group)}

_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "¡¿«»“”„’‘…–—"


def _word(raw: str) -> str:
    return raw.lower().strip(_EDGES)


class _Features(dict):
    """Of a word as written: hashes of the word and of its beginnings."""

    def __missing__(self, raw: str) -> tuple[int, ...]:
        if len(self) >= CACHED:
            self.clear()
        word = _word(raw)
        names = ["w" + word, *("b" + word[:size] for size in range(4, min(8, len(word)) + 1))] if word else []
        found = self[raw] = tuple(xxhash.xxh64_intdigest(name) >> (64 - FEATURE_BITS) for name in names)
        return found


_FEATURES = _Features()


def _forget() -> None:
    _FEATURES.clear()


def features(text: str | None, swap: bool = False) -> np.ndarray:
    """The distinct features of a text, or of its counterfactual."""
    words = set((text or "").split())
    if swap:
        words = {SWAPS.get(_word(word), word) for word in words}
    found: set[int] = set()
    for hashed in map(_FEATURES.__getitem__, words):
        found.update(hashed)
    return np.fromiter(found, np.int64, len(found))


@dataclass(frozen=True)
class Model:
    """Weights by feature; a score is the logistic function of their sum and the intercept."""

    chosen: np.ndarray
    weights: np.ndarray
    intercept: float

    #: Both kinds of labels were there to learn from.
    fitted: bool = True

    def weights_of_all(self) -> np.ndarray:
        """One weight for each possible feature; made once for all texts of a task."""
        full = np.zeros(1 << FEATURE_BITS, np.float32)
        full[self.chosen] = self.weights
        return full

    def score(self, texts: list[str | None], full: np.ndarray | None = None) -> list[float]:
        full = self.weights_of_all() if full is None else full
        return [float(_logistic(self.intercept + full[features(text)].sum(dtype=np.float64))) for text in texts]


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def held_out(doc_id: str):
    """Rows whose labels are not for learning."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, train_rows: int) -> DataFrame:
    known = labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(id_col).agg(F.max("toxic").alias("label"))
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(train_rows)
    texts = docs.select(F.col(id_col), F.coalesce(text_col, F.lit("")).alias("text"))
    # At most ``train_rows`` ids; of an id with several texts the first one in their order stays, so the bound holds for texts.
    return texts.join(F.broadcast(chosen), id_col).groupBy(id_col).agg(F.min("text").alias("text"), F.min("label").alias("label"))


def _counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """How many texts of either label have a feature, and how many there are."""
    width = 1 << FEATURE_BITS

    def count(slices: Iterator[dict], counts: np.ndarray) -> None:
        for part in slices:
            for text, label in zip(part["text"], part["label"], strict=True):
                counts[int(label), features(text)] += 1
                counts[int(label), width] += 1

    clean, toxic = tree_sum(rows, (2, width + 1), count, _forget).astype(np.float64)
    return clean[:width], toxic[:width], int(clean[width]), int(toxic[width])


def _choose(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    """Features whose share among toxic texts differs clearly from that among the others."""
    both = clean + toxic
    share = both / (n_clean + n_toxic)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n_clean + 1 / n_toxic))
    z = np.where(both >= LEAST_TEXTS, np.abs(toxic / n_toxic - clean / n_clean) / spread, 0)
    found = np.flatnonzero(z >= LEAST_Z)
    found = found[np.argsort(-z[found], kind="stable")][:MOST_FEATURES]
    named = [f for word in SWAPS for f in _FEATURES[word]]
    return np.unique(np.concatenate([found, np.array(named, np.int64)]))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS, penalty: float = PENALTY
) -> Model:
    """Learn from labelled texts that are not held out; ``labels`` has the id and ``toxic`` (0 or 1)."""
    rows = _labelled(docs, labels, id_col, text_col, train_rows)
    clean, toxic, n_clean, n_toxic = _counts(rows)
    if not n_clean or not n_toxic:
        return Model(np.empty(0, np.int64), np.empty(0), 500.0 if n_toxic else -500.0, fitted=False)
    chosen = _choose(clean, toxic, n_clean, n_toxic)

    def reduce(slices: Iterator[dict]) -> Iterator[dict]:
        for part in slices:
            pairs = []
            for swap in (False, True):
                hits = []
                for text in part["text"]:
                    at = np.searchsorted(chosen, found := np.sort(features(text, swap)))
                    hits.append(at[chosen[np.minimum(at, len(chosen) - 1)] == found].astype(np.int32))
                pairs.append(hits)
            yield {"own": pairs[0], "swapped": pairs[1], "label": part["label"]}

    # Some tens of numbers for each of at most ``train_rows`` texts.
    data = map_rows(rows, "own array<int>, swapped array<int>, label int", reduce, _forget).collect()
    return _fit(data, chosen, penalty)


def _fit(data: list, chosen: np.ndarray, penalty: float) -> Model:
    """Minimise the logistic loss, the squared weights, and the squared score changes of counterfactuals."""
    # The order of collected rows may differ between runs; sums should not.
    data = sorted(data, key=lambda r: (r["own"], r["swapped"], r["label"]))
    own = [np.array(r["own"], np.int64) for r in data]
    label = np.array([r["label"] for r in data], np.float64)
    rows = np.repeat(np.arange(len(own)), [len(x) for x in own])
    columns = np.concatenate(own) if own else np.empty(0, np.int64)
    changed = [(np.setdiff1d(x, y), np.setdiff1d(y, x)) for x, y in ((r["own"], r["swapped"]) for r in data) if x != y]
    signs = np.concatenate([np.concatenate([np.ones(len(x)), -np.ones(len(y))]) for x, y in changed]) if changed else np.empty(0)
    swap_columns = np.concatenate([np.concatenate(pair) for pair in changed]).astype(np.int64) if changed else np.empty(0, np.int64)
    swap_rows = np.repeat(np.arange(len(changed)), [len(x) + len(y) for x, y in changed])

    size, n = len(chosen), len(label)
    weights, intercept = np.zeros(size), 0.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        wrong = _logistic(intercept + np.bincount(rows, weights[columns], n)) - label
        slope = np.bincount(columns, wrong[rows], size) / n + L2 * weights
        if changed:
            change = np.bincount(swap_rows, signs * weights[swap_columns], len(changed))
            slope += 2 * penalty * np.bincount(swap_columns, signs * change[swap_rows], size) / len(changed)
        gradient = np.append(slope, wrong.mean())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights -= move[:-1]
        intercept -= move[-1]
    return Model(chosen, weights, float(intercept))


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its place, the id and ``score`` from 0 to 1."""
    model = docs.sparkSession.sparkContext.broadcast(model)

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        full = model.value.weights_of_all()
        for part in slices:
            yield {"__file": part["__file"], "__row": part["__row"], id_col: part["id"], "score": model.value.score(part["text"], full)}

    docs = row_keys(docs).select("__file", "__row", F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    return map_rows(docs, f"__file long, __row long, `{id_col}` {kind}, score double", rows, _forget)
