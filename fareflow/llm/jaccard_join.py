"""N-gram Jaccard join (operator 3) by filtering under several global orders.

A text is the set of its word n-grams. If two sets are similar enough, they share a token within the first part of
each, its prefix, whatever the order of tokens that is the same for all texts. Three orders are used: by
rarity, and two that are arbitrary. Pairs that meet at a token of their rarity prefixes are candidates;
they must also share tokens in the prefixes of both other orders, and only then the whole sets are compared.

Groups of near copies share many tokens, so pairs are not all written out. Equal sets are one class. At each token,
the member with the fewest rarer tokens leads, and the others are compared with it first; that joins a group
of copies to their original. Then only members of different components meet, and only if their places in
the rarity order still allow enough common tokens. No pair of texts that could be linked is left out.

Rarity comes from counts over all texts, in a fixed number of slots, so their size does not grow with the corpus.
An order may be any, so slots that several tokens share cost some candidates but lose none. N-grams are
64-bit hashes of their words; sets that are equal by a 128-bit digest are taken as equal.

A missing text counts as empty. A text without words is linked with nothing; one with fewer words than an
n-gram has its whole sequence as its only n-gram. Rows are told apart by their place in the table: ids may repeat
or be missing, and missing ones are passed over when the smallest id is looked for. An empty table gives no
rows; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, dense, map_rows, restrict, row_keys, tree_sum
from .components import components

ROW = ["__file", "__row"]
SLOT_BITS = 22
_SID = (1 << 50) - 1
# Hashed words that a worker keeps.
CACHED = 250_000
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_ORDERS = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_HASHED = _Words()


def _forget() -> None:
    _HASHED.clear()


def shingles(text: str | None, n: int) -> np.ndarray:
    """Hashes of the distinct n-grams, sorted. Words end at ASCII white space; only A-Z are lower-cased."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(_HASHED.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    mixed = np.full(len(words) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            mixed = (mixed ^ hashed[i : len(words) - width + 1 + i]) * _ODD[i % 3]
            mixed ^= mixed >> np.uint64(29)
        mixed *= _ODD[1]
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def prefix_size(size: int, percent: int) -> int:
    """Of sets of similarity ``percent`` or more, one has at most so few tokens before the first common one, and that one."""
    return size - -(-percent * size // 100) + 1


def _counts(docs: DataFrame, n: int) -> np.ndarray:
    """In how many texts a token occurs, added up by slot."""

    def count(slices: Iterator[dict], counts: np.ndarray) -> None:
        for part in slices:
            for text in part["text"]:
                np.add.at(counts, (shingles(text, n) >> np.uint64(64 - SLOT_BITS)).astype(np.int64), 1)

    return tree_sum(docs.select("text"), (1 << SLOT_BITS,), count, _forget)


def _signed(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Per row: its place, id, ``n`` tokens, ``digest`` of the set, and its prefix in the order of rarity."""
    context = docs.sparkSession.sparkContext
    # One byte for each slot: how frequent its tokens are, in steps of an eighth of a doubling.
    levels = context.broadcast(np.minimum(255, 8 * np.log2(_counts(docs, n) + 1.0)).astype(np.uint8))

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        level = levels.value
        for part in slices:
            out: dict[str, list] = {name: [] for name in ("n", "digest", "rare")}
            for text in part["text"]:
                tokens = shingles(text, n)
                size = prefix_size(len(tokens), percent) if len(tokens) else 0
                order = np.lexsort((tokens, level[tokens >> np.uint64(64 - SLOT_BITS)]))[:size]
                out["n"].append(len(tokens))
                out["digest"].append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None)
                out["rare"].append(tokens[order].view(np.int64))
            yield {"__file": part["__file"], "__row": part["__row"], "id": part["id"]} | out

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"__file long, __row long, id {kind}, n long, digest binary, rare array<long>"
    return dense(checkpointed(map_rows(docs, schema, rows, _forget).withColumn("sid", F.monotonically_increasing_id())), "sid")


def _other_orders(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Per ``sid``: the number of tokens, and the prefixes under two arbitrary orders."""

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        for part in slices:
            out: dict[str, list] = {"sid": part["sid"], "n": [], "second": [], "third": []}
            for text in part["text"]:
                tokens = shingles(text, n)
                size = prefix_size(len(tokens), percent)
                out["n"].append(len(tokens))
                with np.errstate(over="ignore"):
                    for name, factor in zip(("second", "third"), _ORDERS, strict=True):
                        mixed = np.sort(tokens * factor)[:size]
                        out[name].append((mixed >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield out

    return map_rows(texts.select("sid", "text"), "sid long, n long, second array<int>, third array<int>", rows, _forget)


def _enough(n1: Column, n2: Column, common: Column, percent: int) -> Column:
    """``common`` tokens would make sets of these sizes similar enough."""
    return 100 * common >= percent * (n1 + n2 - common)


def _nodes(pairs: DataFrame) -> DataFrame:
    return checkpointed(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct())


def _texts(pairs: DataFrame, signed: DataFrame, base: DataFrame) -> DataFrame:
    """The texts that are in a pair, by ``sid``. Others are read but not shuffled."""
    places = checkpointed(restrict(signed.select(*ROW, "sid"), _nodes(pairs), ["sid"], keep=True))
    return restrict(base.select(*ROW, "text"), places, ROW, keep=True)


def _filtered(pairs: DataFrame, signed: DataFrame, base: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs whose sizes are near enough and which share prefix tokens under the other orders too."""
    signs = checkpointed(_other_orders(_texts(pairs, signed, base), n, percent))
    sides = []
    for side in ("a", "b"):
        sides.append(signs.select(F.col("sid").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "second", "third")]))
    pairs = pairs.join(sides[0], "a").join(sides[1], "b")
    return pairs.filter(
        _enough(F.col("n_a"), F.col("n_b"), F.least("n_a", "n_b"), percent)
        & F.arrays_overlap("second_a", "second_b")
        & F.arrays_overlap("third_a", "third_b")
    ).select("a", "b")


def _verified(pairs: DataFrame, signed: DataFrame, base: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs that are similar enough, by their whole sets."""
    pairs = checkpointed(pairs)
    texts = _texts(pairs, signed, base)
    first = texts.select(F.col("sid").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("sid").alias("b"), F.col("text").alias("text_b"))

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        for part in slices:
            links: dict[str, list] = {"a": [], "b": []}
            held, tokens = None, None
            for a, b, text_a, text_b in zip(*(part[c] for c in ("a", "b", "text_a", "text_b")), strict=True):
                if a != held:
                    held, tokens = a, shingles(text_a, n)
                other = shingles(text_b, n)
                common = np.intersect1d(tokens, other, assume_unique=True).size
                if 100 * common >= percent * (len(tokens) + len(other) - common):
                    links["a"].append(a)
                    links["b"].append(b)
            yield links

    joined = pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b")
    return checkpointed(map_rows(joined, "a long, b long", rows, _forget))


def _first_look(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signed rows, the classes of equal sets, and the postings of tokens at which several classes meet."""
    signed = _signed(docs, n, percent)
    full = signed.filter("n > 0")
    head = F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "sid")).alias("head")
    classes = checkpointed(full.groupBy("digest").agg(F.min("sid").alias("rep"), head, F.count("*").alias("rows")))
    # Rows that repeat an earlier set need no postings of their own.
    again = full.select("sid", "digest").join(classes.filter("rows > 1").select("digest", "rep"), "digest").filter("sid > rep").select("sid")
    reps = restrict(full, checkpointed(again), ["sid"], keep=False)
    # Place and row in one number: the least one leads. Places beyond 13 bits count as equal.
    packed = F.shiftleft(F.least("pos", F.lit(8191)).cast("long"), 50).bitwiseOR(F.col("sid")).alias("packed")
    postings = reps.select("sid", "n", F.posexplode("rare").alias("pos", "token")).select("token", "n", packed)
    # Postings go to their tokens once: both the leaders and the members read that shuffle. It is the same one for both only
    # if both ask for the same columns, which is why the sum is there.
    postings = postings.repartition("token")
    led = postings.groupBy("token").agg(F.min("packed").alias("least"), F.max("packed").alias("most"), F.sum("n").alias("sizes"))
    led = led.filter("least < most AND sizes > 0").select("token", F.col("least").bitwiseAND(_SID).alias("lead"))
    pos, sid = F.shiftright("packed", 50).cast("int"), F.col("packed").bitwiseAND(_SID)
    meeting = postings.join(led, "token").select("token", sid.alias("sid"), "n", pos.alias("pos"), "lead")
    return signed, classes, checkpointed(meeting)


def near_duplicates(
    docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: its place, the id, ``n_shingles``, ``component_id`` and ``first``: of its component, it is the row
    of the smallest id.

    Two texts are linked if the share of common n-grams among all of both is ``percent`` or more; components are
    what links connect.
    """
    base = row_keys(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *ROW)
    signed, classes, meeting = _first_look(base, n, percent)

    lead = meeting.filter("sid = lead").select("token", F.col("pos").alias("lead_pos"), F.col("n").alias("lead_n"))
    room = lambda n1, p1, n2, p2: _enough(F.col(n1), F.col(n2), F.least(F.col(n1) - F.col(p1), F.col(n2) - F.col(p2)), percent)
    pairs = meeting.filter("sid <> lead").join(lead, "token").filter(room("n", "pos", "lead_n", "lead_pos"))
    pairs = checkpointed(pairs.select(F.col("lead").alias("a"), F.col("sid").alias("b")).distinct())
    links = _verified(_filtered(pairs, signed, base, n, percent), signed, base, n, percent)

    # What the leaders did not join: members of different components that meet at a token.
    labels = checkpointed(components(links))
    labelled = meeting.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    mixed = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    labelled = checkpointed(restrict(labelled, checkpointed(mixed.select("token")), ["token"], keep=True))
    lead = labelled.filter("sid = lead").select("token", F.col("label").alias("lead_label"))
    labelled = checkpointed(labelled.join(lead, "token"))
    apart = labelled.filter("label <> lead_label").select("token", *[F.col(c).alias(f"{c}1") for c in ("sid", "n", "pos", "label")])
    others = labelled.select("token", *[F.col(c).alias(f"{c}2") for c in ("sid", "n", "pos", "label")], "lead_label")
    met = apart.join(others, "token").filter(
        (F.col("label1") != F.col("label2"))
        & ((F.col("label2") == F.col("lead_label")) | (F.col("sid1") < F.col("sid2")))
        & room("n1", "pos1", "n2", "pos2")
    )
    later = met.select(F.least("sid1", "sid2").alias("a"), F.greatest("sid1", "sid2").alias("b")).distinct()
    done = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    later = checkpointed(later.join(done, ["a", "b"], "left_anti"))
    links = links.union(_verified(_filtered(later, signed, base, n, percent), signed, base, n, percent))
    labels = components(links)

    # From rows to classes, from classes to components, and back.
    named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    named = checkpointed(named)
    least = checkpointed(named.groupBy("label").agg(F.min("head").alias("least")))
    named = named.join(least, "label")
    named = checkpointed(named.select("digest", F.col("least.id").alias("component_id"), F.col("least.sid").alias("first_sid")))
    rows = signed.select(*ROW, "id", "sid", "n", "digest").join(named, "digest", "left")
    return rows.select(
        *ROW,
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.coalesce(F.col("sid") == F.col("first_sid"), F.lit(True)).alias("first"),
    )
