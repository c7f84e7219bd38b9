"""Every operator over odd rows and over an empty table, held against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

from chronolake.llm import classifier, exact_dedup, mixing, near_dedup, packing, pii, quality_rules, sharding

from .conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + o for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for o in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, odd_docs, no_docs, no_labels):
    got = quality_rules.quality_rules(odd_docs, no_labels).collect()
    found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert found == Counter((r[0], *plain_counts(r[1])) for r in ROWS)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)
    kept = quality_rules.keep_good(odd_docs, no_labels)
    assert kept.columns == odd_docs.columns
    assert quality_rules.quality_rules(no_docs, no_labels).count() == 0


def test_exact_dedup(odd_docs, no_docs):
    norm = {id(r): re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "") for r in ROWS}
    groups = defaultdict(list)
    for r in ROWS:
        groups[norm[id(r)]].append(r[0])
    want = Counter()
    for r in ROWS:
        ids = [i for i in groups[norm[id(r)]] if i is not None]
        keep = max(ids) if ids else None
        want[(r[0], keep, len(groups[norm[id(r)]]), r[0] == keep, hashlib.sha256(norm[id(r)].encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in exact_dedup.exact_dedup(odd_docs).collect()) == want
    left = exact_dedup.drop_copies(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in left.select("doc_id").collect()) == sorted(["10", "3", "4", "5", "7", "7", "8", "9", "None"])
    assert exact_dedup.exact_dedup(no_docs).count() == 0


def test_near_classes(odd_docs, no_docs):
    got = [tuple(r) for r in near_dedup.near_classes(odd_docs).collect()]
    assert len(got) == len(ROWS)
    classes = {i: c for i, c, _, _ in got}
    assert classes[1] == classes[6] == classes[7] == 1
    assert classes[2] == classes[3] == classes[4] == 2
    assert classes[None] is None and {classes[i] for i in (5, 8, 9, 10)} == {5, 8, 9, 10}
    assert Counter(n for i, c, n, _ in got if c == 1) == {4: 4}
    assert near_dedup.near_classes(no_docs).count() == 0


def test_only_the_copies_of_an_id_go(spark):
    """Rows that share a null or repeated doc_id with a copy stay if their own text is no copy."""
    words = [" ".join(f"w{i}{j}" for j in range(40)) for i in range(5)]
    rows = [(None, words[0]), (None, words[1]), (1, words[1]), (2, words[1]), (2, words[2]), (3, words[3]), (3, words[4]), (4, words[4]), (None, None), (0, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    exact = {(None, words[0]), (2, words[1]), (2, words[2]), (3, words[3]), (4, words[4]), (0, "")}
    assert Counter(tuple(r) for r in exact_dedup.drop_copies(docs).collect()) == Counter(exact)
    near = {(None, words[0]), (1, words[1]), (2, words[2]), (3, words[3]), (3, words[4]), (0, "")}
    assert Counter(tuple(r) for r in near_dedup.drop_near_copies(docs).collect()) == Counter(near)


def test_packing(odd_docs, no_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for r in ROWS:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = ids[start : start + 2048]
            want[(r[0], piece, start, len(own), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in own)))] += 1
    got = packing.pack(odd_docs).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    placed = defaultdict(list)
    for r in got:
        placed[r.sequence_id].append((r.offset, r.length))
    for spans in placed.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(placed) == -(-sum(r.length for r in got) // 2048)
    assert packing.pack(no_docs).count() == 0


def test_classifier(odd_docs, no_docs, no_labels):
    got = classifier.score_quality(odd_docs, no_labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.held_out for r in got} == {r[0]: zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 5 == 0 for r in ROWS}
    assert classifier.score_quality(no_docs, no_labels).count() == 0


def test_mixing(odd_docs, no_docs):
    got = mixing.mix(odd_docs).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((r[0], r[3], len(WORD.findall(r[1] or ""))) for r in ROWS)
    sizes = Counter()
    for r in ROWS:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    open_, target = set(sizes), {}
    while True:  # reshare what is over three times a source's size
        left = sum(sizes.values()) - sum(target.values())
        over = [s for s in open_ if weight[s] * left > 3 * sizes[s] * sum(weight[o] for o in open_)]
        if not over:
            break
        for s in over:
            target[s] = 3 * sizes[s]
            open_.discard(s)
    for s in open_:
        target[s] = weight[s] * left / sum(weight[o] for o in open_)
    taken = Counter()
    for r in got:
        assert abs(r.target - target[r.source]) < 1e-6 and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max([r.size for r in got if r.source == s])
    rows = mixing.take(odd_docs)
    assert rows.columns == odd_docs.columns
    assert Counter(r.doc_id for r in rows.collect() if r.doc_id != 7) == Counter(
        {r.doc_id: r.epochs for r in got if r.doc_id != 7 and r.epochs}
    )
    assert mixing.mix(no_docs).count() == 0 and mixing.take(no_docs).count() == 0


def test_rows_that_share_an_id_are_taken_for_themselves(spark):
    """Null and repeated ids, equal sizes and equal rows: what is taken is what the mix counts."""
    rows = [(None, f"{'w ' * 35}{i}", "a") for i in range(200)] + [(7, "x " * 36, "a")] * 60 + [(i, "y " * 50, "b") for i in range(20)] + [(None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    mixed = Counter()
    for r in mixing.mix(docs).collect():
        mixed[r.source] += r.taken
    got = Counter()
    for r in mixing.take(docs).collect():
        got[r.source] += len(WORD.findall(r.text or ""))
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in mixed.items() if v}


def test_sharding(odd_docs, no_docs):
    got = sharding.shard_documents(odd_docs.union(odd_docs)).collect()
    counts = Counter(r.shard for r in got)
    assert len(got) == 2 * len(ROWS) and max(counts.values()) - min(counts.get(s, 0) for s in range(16)) <= 1
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in ROWS)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want + want
    assert sharding.shard_documents(no_docs).count() == 0


def test_pseudonyms(odd_docs, no_docs):
    done = pii.pseudonymise(odd_docs, "k")
    assert set(done.columns) == set(odd_docs.columns)
    assert Counter((r.doc_id, r.text) for r in done.collect()) == Counter((r[0], r[1]) for r in ROWS)
    assert pii.pseudonymise(no_docs, "k").count() == 0
