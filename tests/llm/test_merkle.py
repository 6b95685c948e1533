from __future__ import annotations

from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from fareflow.llm import catalogue, merkle
from pyspark.sql import functions as F


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and for each leaf what is left and right of it in its runs."""
    ways = [[] for _ in leaves]
    at, level = list(range(len(leaves))), leaves
    while len(level) > 1:
        for leaf, i in enumerate(at):
            run = i // 3 * 3
            ways[leaf].append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
        level = [digest("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
        at = [i // 3 for i in at]
    return level[0], ways


def plain(rows):
    """All columns of the query for rows of (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for i, text, lang, source, n in rows:
        leaf = digest("".join(map(field, (i, source, lang, n, text))))
        changed = leaf
        if i is not None and crc32(str(i).encode()) % 2 == 0 and text is not None:
            changed = digest("".join(map(field, (i, source, lang, n, text.replace("\n", "")))))
        key = (source is not None, (source or "").encode())
        groups.setdefault(key, []).append(((i is not None, i or 0, leaf), leaf, changed))
    trees = {}
    for key, held in groups.items():
        held.sort()
        trees[key] = plain_tree([leaf for _, leaf, _ in held])
    order = sorted(groups)
    root, above = plain_tree([trees[key][0] for key in order])
    out = []
    for key, way in zip(order, above, strict=True):
        subroot, ways = trees[key]
        for ((_, _, _), leaf, changed), steps in zip(groups[key], ways, strict=True):
            steps = steps + way
            folded = changed
            for left, right in steps:
                folded = digest(left + folded + right)
            proof = digest("".join(left + right for left, right in steps))
            out.append((leaf, subroot, root, proof, folded, folded == root))
    return sorted(out)


def run(spark, tmp_path, rows, name="documents"):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).withColumns({"key": F.lit("x"), "idx": F.lit(1), "total": F.lit(0)})
    docs.repartition(5).write.parquet(f"{tmp_path}/{name}.parquet")
    found = catalogue.QUERIES["op11_merkle"](spark, str(tmp_path)).collect()
    return sorted((r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in found), found


def sample(sizes):
    rows, i = [], 0
    for source, size in sizes:
        for _ in range(size):
            i += 7
            rows.append((i, f"text {i}\nsecond" if i % 3 else None, "de" if i % 2 else None, source, i % 5))
    return rows


def test_small_sources(spark, tmp_path):
    rows = sample([("a", 1), ("b", 2), ("B", 3), (None, 4), ("", 10), ("é", 28), ("zz", 82)])
    found, raw = run(spark, tmp_path, rows)
    assert found == plain(rows)
    assert {r.doc_id for r in raw} == {r[0] for r in rows}
    assert any(not r.verified for r in raw) and any(r.verified for r in raw)


def test_one_source_of_one_row_and_no_rows(spark, tmp_path):
    found, _ = run(spark, tmp_path, [(4, "x\ny", None, None, None)])
    assert found == plain([(4, "x\ny", None, None, None)])
    empty, _ = run(spark, tmp_path / "none", [])
    assert empty == []


def test_repeated_and_missing_ids(spark, tmp_path):
    rows = [(None, "a", "x", "s", 1), (None, "b", "x", "s", 1), (3, "c\n", "x", "s", 1), (3, "c\n", "x", "s", 1), (3, "b", "x", "s", 1)] * 4
    found, _ = run(spark, tmp_path, rows)
    # Rows that tie in all have equal leaves; of them only the set of proofs is defined.
    assert found == plain(rows)


@pytest.mark.parametrize("height", [1, 2])
def test_many_blocks(spark, tmp_path, monkeypatch, height):
    # Small blocks, so that trees take several levels of tables, with last blocks of all fillings.
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "BLOCK", 3**height)
    rows = sample([("a", 1), ("b", 9), ("c", 10), ("d", 27), ("e", 28), ("f", 100), ("g", 3), ("h", 82), ("i", 2), ("j", 4), ("k", 5)])
    found, _ = run(spark, tmp_path, rows)
    assert found == plain(rows)


def test_addresses_fill_the_layout_and_keep_subtrees_together():
    for levels in range(1, 8):
        places = np.concatenate([merkle.address(levels, d, np.arange(3**d)) for d in range(levels)])
        assert sorted(places) == list(range((3**levels - 1) // 2))
    # Four levels: the upper two come first, then each lower half in one piece.
    assert list(merkle.address(4, 2, np.arange(9))) == [4 + 4 * i for i in range(9)]
    assert list(merkle.address(4, 3, np.arange(3))) == [5, 6, 7]


def test_a_proof_by_hand():
    leaves = [sha256(bytes([i])).digest() for i in range(5)]
    levels = merkle._height(5)
    laid = merkle.block_levels(merkle.build_block(leaves, levels), levels, 5)
    a = [x.hex() for x in leaves]
    left, right = digest("".join(a[:3])), digest("".join(a[3:]))
    assert laid[-1] == digest(left + right)
    assert list(merkle.siblings(laid, 4)) == [(a[3], ""), (left, "")]
    assert merkle.fold(a[4], list(merkle.siblings(laid, 4))) == laid[-1]
    assert merkle.fold(a[0], list(merkle.siblings(laid, 4))) != laid[-1]
