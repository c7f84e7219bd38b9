"""The Merkle manifest and its versions, held against trees that are built anew."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chronolake.llm import merkle

from .conftest import ROWS


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[i : i + 16]) for i in range(0, len(low), 16)])
    return levels


def siblings(levels, i):
    out = []
    for low in levels[:-1]:
        run = low[i // 16 * 16 : i // 16 * 16 + 16]
        out += run[: i % 16] + run[i % 16 + 1 :]
        i //= 16
    return out


def truth(rows):
    """rows (doc_id, text, lang, source, n_chars) -> proofs as the query gives them, and all trees."""
    by = {}
    for d, text, lang, source, n in rows:
        by.setdefault(source, []).append((d, leaf_of(d, source, lang, n, text), text, lang, n))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = climb([r[1] for r in by[s]])
    top = climb([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for i, (d, leaf, text, lang, n) in enumerate(by[s]):
            changed = d is not None and zlib.crc32(str(d).encode()) % 5 == 0
            lowered = text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            new = leaf_of(d, s, lang, n, lowered) if changed else leaf
            own = climb([new if j == i else r[1] for j, r in enumerate(by[s])])
            whole = climb([own[-1][0] if j == place else trees[o][-1][0] for j, o in enumerate(order)])
            proof = h(*siblings(trees[s], i), *siblings(top, place))
            out.append((d, leaf, trees[s][-1][0], top[-1][0], proof, whole[-1][0], whole[-1][0] == top[-1][0]))
    return out, trees, top


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, True) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, leaf string, idx int, top boolean")


def check(spark, rows):
    got = merkle.proofs(docs_of(spark, rows).repartition(4)).collect()
    want, _, _ = truth(rows)
    assert Counter(map(tuple, got)) == Counter(want)


def test_odd_rows(spark):
    check(spark, [(*r, None if r[1] is None else len(r[1])) for r in ROWS])


def test_no_rows_and_one(spark):
    check(spark, [])
    check(spark, [(5, "One Text", "en", None, 8)])


def sized(sizes):
    return [(100_000 * g + 7 * i, f"Text {i} of {g}", "en", f"s{g:03}", i) for g, n in enumerate(sizes) for i in range(n)]


@pytest.mark.parametrize("sizes", [[16, 17, 1, 256, 257, 15], [1] * 40, [4097, 3, 300]])
def test_sizes_of_trees(spark, sizes):
    check(spark, sized(sizes))


def test_small_blocks_give_the_same_tree(spark):
    """With one level to a block every level is a round: paths and versions go up through many of them."""
    rows = sized([300, 40, 1, 17] + [2] * 20)
    got = merkle.Manifest(docs_of(spark, rows), rise=1).rows.collect()
    want, _, _ = truth(rows)
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got) == Counter(w[:6] for w in want)


def test_versions_share_all_untouched_nodes(spark):
    """A version's tree is the base tree but for the changed leaf and its ancestors."""
    rows = sized([300, 17, 1])
    manifest = merkle.Manifest(docs_of(spark, rows))
    want, trees, top = truth(rows)
    base = {(r.tree, r.level, r.idx): r.digest for r in manifest.nodes.collect()}
    full = {("s" + s, level, i): d for s, levels in trees.items() for level, low in enumerate(levels) for i, d in enumerate(low)}
    assert base == full | {("", level, i): d for level, low in enumerate(top) for i, d in enumerate(low)}
    copied = {}
    for r in manifest.versions().collect():
        copied.setdefault(r.version, {})[(r.tree, r.level, r.idx)] = r.digest
    assert copied.keys() == {d for d, *_ in rows if zlib.crc32(str(d).encode()) % 5 == 0}
    folded = {w[0]: w[5] for w in want}
    places = {d: (s, sum(o[3] == s and o[0] < d for o in rows)) for d, _, _, s, _ in rows}
    for version, own in list(copied.items())[:40]:
        seen = base | own
        source, i = places[version]
        name, levels = "s" + source, trees[source]
        for level in range(1, len(levels)):  # each ancestor is the hash of its children as the version sees them
            i //= 16
            below = [seen[(name, level - 1, j)] for j in range(16 * i, min(16 * i + 16, len(levels[level - 1])))]
            assert own[(name, level, i)] == h(*below)
        root = max(k for k in own if k[0] == "")
        assert own[root] == folded[version] and len(own) == len(levels) + len(top)


def test_leaf_hashes_bytes(spark):
    row = spark.range(1).select(merkle.leaf(doc_id=F.lit(12), source=F.lit("ä"), lang=F.lit(None).cast("string"), n_chars=F.lit(3), text=F.lit("")).alias("x")).first()
    assert row.x == h("2:12", "2:ä", "-", "1:3", "0:")
