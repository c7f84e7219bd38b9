"""The methods by themselves: against brute force, exact round trips and held-out labels."""

import itertools
import json
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronolake.llm import chat, classifier, exact_dedup, near_dedup, packing, pii, quality_rules, sharding, warc

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def binomial(n, k, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_binomial_tail_is_exact(spark):
    cases = [(n, k) for n in (1, 5, 600, 2000) for k in (0, 1, 3, 7, 15) if k < n * 0.01 or k <= n]
    rows = spark.createDataFrame(cases, "n long, k long").withColumn("p", quality_rules.binomial_tail(F.col("n"), F.col("k"), 0.01)).collect()
    for r in rows:
        assert r.p == pytest.approx(1.0 if r.k >= r.n * 0.01 else binomial(r.n, r.k, 0.01), rel=1e-9)


def test_rules_are_proven_on_holdout(spark):
    """A rule that separates is used once labels suffice, and not before; false rejections stay bounded."""
    rng = random.Random(3)

    def text(bad):
        w = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(60)]
        return " ".join(x + "###" if bad else x for x in w)

    docs = [(i, text(i % 5 == 0), "en" if i < 3000 else "de") for i in range(3100)]
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(3100)], "doc_id long, quality int, toxic int")
    got = quality_rules.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string"), labels).collect()
    assert all(r.kept == (r.doc_id % 5 != 0) for r in got if r.lang == "en")
    assert all(r.kept for r in got if r.lang == "de")  # 80 good ones prove nothing


def plain(text):
    bare = re.sub(r"[^\w]|_", " ", text.lower()).split()
    return bare


def near_truth(texts):
    grams = {}
    for i, t in texts.items():
        w, seen, out = plain(t), Counter(), set()
        for k in [tuple(w)] if len(w) < 5 else [tuple(w[j : j + 5]) for j in range(len(w) - 4)]:
            out.add((k, seen[k]))
            seen[k] += 1
        grams[i] = out
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and (n := len(grams[a] & grams[b])) >= 0.8 * (len(grams[a]) + len(grams[b]) - n):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_classes_equal_brute_force(spark):
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    texts, n = {}, 0
    for base in range(25):
        own = [rng.choice(words) for _ in range(rng.randint(40, 300))]
        if base % 3 == 0:
            own = passage + own[:40]
        for copy in range(rng.randint(1, 8)):
            made = list(own)
            for _ in range(rng.randint(0, max(1, len(own) // 60))):
                made[rng.randrange(len(made))] = rng.choice(words)
            texts[n] = (" ".join(made) + ".").capitalize() if copy % 2 else " ".join(made)
            n += 1
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs).collect()}
    assert got == near_truth(texts)


def hub_groups(sizes, seed=11):
    """Base texts of 500 words, each with copies that have 10 words changed: 0.817 to the base, about 0.66 to each other."""
    rng = random.Random(seed)
    texts, group = {}, {}
    for g, size in enumerate(sizes):
        base = [f"{rng.randrange(10**6)}x" for _ in range(500)]
        for copy in range(size + 1):
            made = list(base)
            for at in rng.sample(range(1, 98), 10) if copy else ():
                made[5 * at] = f"{rng.randrange(10**6)}y"
            i = rng.randrange(10**9)
            texts[i], group[i] = " ".join(made), g
    return texts, group


def test_near_classes_of_hub_groups(spark):
    """Copies that are near their base text only are one class with it, however many they are."""
    texts, group = hub_groups([20] * 10 + [1000])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    least = {g: min(i for i in group if group[i] == g) for g in set(group.values())}
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs).collect()}
    assert got == {i: least[g] for i, g in group.items()}
    some = {i: texts[i] for i in texts if group[i] < 2}
    assert near_truth(some) == {i: least[group[i]] for i in some}


def test_unlike_copies_are_ruled_out_without_their_texts(spark, monkeypatch):
    """Copies about 0.67 to each other share many bands; only pairs near 0.8 are aligned, and no link is lost."""
    rng = random.Random(5)
    base = [f"{rng.randrange(10**6)}x" for _ in range(150)]
    texts = {}
    for i in range(300):
        made = list(base)
        for at in rng.sample(range(1, 29), 1 if i % 50 == 0 else 3):
            made[5 * at] = f"{rng.randrange(10**6)}y"
        texts[i] = " ".join(made)
    aligned, verified = [], near_dedup.verified
    monkeypatch.setattr(near_dedup, "verified", lambda pairs, grams: aligned.append(pairs.count()) or verified(pairs, grams))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dedup.near_classes(docs).collect()} == near_truth(texts)
    assert sum(aligned) <= 2 * len(texts)


def test_odd_sketches_never_differ_in_more_cells_than_texts_in_kmers():
    rng = np.random.default_rng(2)
    for n, gone in ((1, 0), (1, 1), (150, 10), (150, 40), (4000, 300), (40_000, 9000)):
        kmers = rng.integers(1, 2**63, n).astype(np.uint64)
        other = np.concatenate([kmers[gone:], rng.integers(1, 2**63, gone).astype(np.uint64)])
        cells = sum(int(x).bit_count() for x in (near_dedup.odd_sketch(kmers) ^ near_dedup.odd_sketch(other)).view(np.uint64))
        assert cells <= 2 * gone and cells % 2 == 0
        assert n > 1000 or cells >= 1.8 * gone


def test_alignment_needs_order():
    a = np.arange(1, 400, dtype=np.int64)
    assert near_dedup.similarity(a, a) == 1.0
    assert near_dedup.similarity(a, np.concatenate([a[200:], a[:200]])) < 0.8
    assert near_dedup.similarity(a, np.delete(a, 50)) > 0.95


def test_repeats_are_labelled():
    kmers = near_dedup.labelled_kmers(np.ones(50, dtype=np.int64))
    assert len(set(kmers.tolist())) == 46


def test_cuckoo_filter_inserts_deletes_and_grows():
    keys = [i.to_bytes(8, "little") * 4 for i in range(5000)]
    made = exact_dedup.CuckooFilter.of(keys)
    assert all(k in made for k in keys)
    assert all(made.delete(k) for k in keys[:2500]) and all(k in made for k in keys[2500:])
    again = exact_dedup.CuckooFilter.unpack(made.slots, made.pack())
    assert all(k in again for k in keys[2500:])
    small = exact_dedup.Bucket()
    for k in keys:
        small.add(k, 1)
    assert small.filter.slots * 4 >= 5000 and all(small.remove(k) for k in keys) and not small.remove(keys[0])


def test_index_update(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "doc_id long, text string")
    index = exact_dedup.build_index(docs, 4)
    gone = exact_dedup.digests(docs.where("doc_id = 1"), 4).select("digest")
    more = spark.createDataFrame([(9, "B"), (8, "c")], "doc_id long, text string")
    new = exact_dedup.update_index(index, more, gone, 4)
    assert sorted((r.keep_id, r.copies) for r in new.collect()) == [(8, 1), (9, 3)]
    packed = {r.bucket: exact_dedup.CuckooFilter.unpack(r.slots, r.fingerprints) for r in exact_dedup.filters(new).collect()}
    assert all(bytes(r.digest) in packed[r.bucket] for r in new.collect())


def test_encoder_equals_the_tokenizer(spark):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts += ["it's <|startoftext|> é ﬁ ² ½ \u0085 x\x1cy </w> '' 's DON'T a b", "<|endoftext|>", "ΑΣ ας"]
    encoder = packing.Encoder(packing.default_tokenizer())
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_swap_search_empties_bins():
    # Best fit leaves 6+3 and 5+4 and 2; one for one and moves make two bins of ten.
    lengths = [6, 3, 5, 4, 2]
    out = packing.swap_search(lengths, [[0, 1], [2, 3], [4]], 10)
    assert len(out) == 2 and sorted(i for b in out for i in b) == [0, 1, 2, 3, 4]
    assert all(sum(lengths[i] for i in b) <= 10 for b in out)
    rng = random.Random(1)
    lengths = [rng.randint(1, 700) for _ in range(3000)]
    bins = packing.best_fit(lengths, 2048)
    out = packing.swap_search(lengths, bins, 2048)
    assert sorted(i for b in out for i in b) == list(range(3000)) and len(out) <= len(bins)
    assert len(out) == -(-sum(lengths) // 2048)


def _steps_left(lengths, bins, size):
    """Steps between any two bins that move length into the fuller one, found by trying all."""
    found = 0
    for giver, taker in itertools.permutations([b for b in bins if sum(lengths[i] for i in b) < size], 2):
        room = size - sum(lengths[i] for i in taker)
        if size - sum(lengths[i] for i in giver) < room:
            continue
        ones = [lengths[i] for i in giver]
        theirs = [lengths[i] for i in taker]
        twos, their_twos = ([a + b for a, b in itertools.combinations(x, 2)] for x in (ones, theirs))
        moves = [n - m for n in ones for m in [0, *theirs, *their_twos]] + [n - m for n in twos for m in theirs]
        found += any(0 < d <= room for d in moves)
    return found


def test_swap_search_ends_where_no_step_is_left():
    rng = random.Random(4)
    for low, high, n in ((500, 900, 120), (300, 1300, 90), (40, 1500, 150), (1000, 1000, 30), (100, 800, 200)):
        lengths = [rng.randint(low, high) for _ in range(n)]
        bins = packing.best_fit(lengths, 2048)
        search = packing.SwapSearch(lengths, bins, 2048)
        out = search.run()
        assert sorted(i for b in out for i in b) == list(range(n))
        assert all(sum(lengths[i] for i in b) <= 2048 for b in out)
        assert packing.least_bins(lengths, 2048) <= len(out) <= len(bins)
        assert len(out) == packing.least_bins(lengths, 2048) or not _steps_left(lengths, out, 2048)
        squares = [sum(sum(lengths[i] for i in b) ** 2 for b in x) for x in (bins, out)]
        assert squares[1] >= squares[0] + search.steps


def test_swap_search_beats_best_fit():
    rng = random.Random(1)
    lengths = [rng.randint(500, 900) for _ in range(2000)]
    bins = packing.best_fit(lengths, 2048)
    out = packing.swap_search(lengths, bins, 2048)
    assert len(out) <= 0.96 * len(bins)


def test_no_packing_goes_below_the_least_bins():
    def optimum(lengths, size):
        best = [len(lengths)]

        def place(at, rooms):
            if len(rooms) >= best[0]:
                return
            if at == len(lengths):
                best[0] = len(rooms)
                return
            for b in range(len(rooms)):
                if rooms[b] >= lengths[at]:
                    place(at + 1, [r - lengths[at] * (i == b) for i, r in enumerate(rooms)])
            place(at + 1, [*rooms, size - lengths[at]])

        place(0, [])
        return best[0]

    rng = random.Random(3)
    for _ in range(150):
        lengths = [rng.randint(1, 10) for _ in range(rng.randint(1, 7))]
        assert packing.least_bins(lengths, 10) <= optimum(lengths, 10)
    assert packing.least_bins([6, 6, 6, 4], 10) == 3 and packing.least_bins([7, 7, 5, 5, 5], 10) == 4


def test_search_report(spark):
    text = "word " * 700
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.substring(F.lit(text), 1, (F.col("id") * 37 % 23 + 90) * 30).alias("text"))
    report = packing.search_report(docs, length=1024).collect()
    assert sum(r.pieces for r in report if r["round"] == 0) == 60
    assert all(r.least <= r.searched <= r.fitted for r in report)
    placed = packing.pack(docs, length=1024)
    assert placed.select("sequence_id").distinct().count() == report[-1].searched


def test_packing_over_several_groups(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    report = packing.fill_report(packing.pack(docs, group_rows=40)).first()
    assert report.sequences <= 1.03 * -(-report.tokens // 2048) + 1


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = classifier.score_quality(docs, labels).join(labels.groupBy("doc_id").agg(F.max("quality").alias("q")), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.q for r in got) >= 0.9 * len(got)


def test_isotonic_pools_violators():
    x, y = classifier.isotonic(np.array([0.0, 1, 2, 3]), np.array([0.0, 1, 0, 1]), np.ones(4))
    assert y.tolist() == [0, 0.5, 1] and x.tolist() == [0, 1.5, 3]


def test_layouts_become_turns(spark):
    lines = [
        {"id": 1, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"id": 2, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"id": 3, "prompt": "q", "completion": "a"},
        {"id": 4, "instruction": "q", "output": "a"},
        {"id": 5, "instruction": "q", "input": "more", "output": "a"},
        {"id": 6, "question": "q"},
    ]
    records = spark.read.json(spark.sparkContext.parallelize([json.dumps(x) for x in lines]))
    got = {r.id: r for r in chat.canonical(records, ("id",)).collect()}
    for i in range(1, 5):
        assert [tuple(t) for t in got[i].turns] == [("user", "q"), ("assistant", "a")]
    assert got[5].turns[0].text == "q\nmore" and got[5].layout == "instruction_input"
    assert got[6].layout is None and got[6].turns is None


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "<s>", "[\\INST] <\\\\/s> [/", "", None, "plain & <b>", "$1 \\2 \n x", "<" * 5 + "/s>"]
    rows = [(c, t, r, texts[(c + t) % len(texts)]) for c in range(9) for t, r in enumerate(("system", "user", "assistant", "to%0Aol\n<s>", None))]
    rows += [(None, None, "user", "x"), (None, 1, "assistant", "y"), (3, 0, "system", texts[3]), (3, 0, "system", texts[3])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, layout int")
    for r in chat.read_back(chat.format_conversations(df)).collect():
        want = sorted(((t is not None, t), ro or "", te or "") for c, t, ro, te in rows if c == r.conv_id)
        assert [tuple(t) for t in r.read_turns] == [(ro, te) for _, ro, te in want]
        assert r.read_loss == "".join(te for _, ro, te in want if ro == "assistant")
    assert chat.format_conversations(df.where("false")).count() == 0


def test_pseudonyms_keep_format_and_link(spark):
    texts = [
        "call +1 (456) 555-2186 or 456-555-2186 or +1 (017) 555-7713, write bosbt.42@mail8.example.com",
        "card 4944339490429605, 4944 3394 9042 9605, not 4944339490429606",
        "born 1987-02-28, 28.02.1987, 02/28/1987, not 1987-02-30; 123-45-6789, not 000-12-1234",
        "at 89.189.210.185, not 999.1.1.1 or 1.2.3.4.5; +49 151 12345678; long.local.part.of.thirty.two.x@a.bc",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    done = pii.pseudonymise(df, "k").orderBy("doc_id")
    rows = done.collect()
    given = {p.found: p.given for r in rows for p in r.pii}
    assert len(given) == 13 and all(a != b for a, b in given.items())
    assert re.fullmatch(r"\+1 \([2-9]\d\d\) \d{3}-\d{4}", given["+1 (456) 555-2186"])
    assert re.sub(r"\D", "", given["+1 (456) 555-2186"])[1:] == re.sub(r"\D", "", given["456-555-2186"])
    assert re.fullmatch(r"\+1 \([01]\d\d\) \d{3}-\d{4}", given["+1 (017) 555-7713"])
    assert given["4944 3394 9042 9605"].replace(" ", "") == given["4944339490429605"]
    assert given["1987-02-28"] == "-".join(given["28.02.1987"].split(".")[::-1])
    for kept in ("4944339490429606", "1987-02-30", "000-12-1234", "999.1.1.1", "1.2.3.4.5"):
        assert any(kept in r.text for r in rows)
    back = pii.pseudonymise(done.select("doc_id", "text"), "k", back=True).orderBy("doc_id").collect()
    assert [r.text for r in back] == texts
    other = pii.pseudonymise(df, "other").orderBy("doc_id").collect()
    assert all(a.text != b.text for a, b in zip(rows, other, strict=True))


def test_every_first_octet_is_replaced(spark):
    texts = [f"from {o}.{o2}.104.120 to" for o in range(256) for o2 in (0, 254, 255)] + ["at 256.1.1.1", "at 233.254.104.256"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    done = pii.pseudonymise(df, "k").orderBy("doc_id")
    rows = done.collect()
    found = [p for r in rows for p in r.pii]
    assert len(found) == 3 * 256 == len({p.given for p in found}) and {p.kind for p in found} == {"ipv4"}
    for p in found:
        given = [int(x) for x in p.given.split(".")]
        assert p.given != p.found and max(given) < 256
        assert (1 <= given[0] <= 223) == (1 <= int(p.found.split(".")[0]) <= 223)
    assert [r.text for r in rows[-2:]] == texts[-2:]
    assert [r.text for r in pii.pseudonymise(done.select("doc_id", "text"), "k", back=True).orderBy("doc_id").collect()] == texts


def test_feistel_is_a_permutation(spark):
    pairs = spark.range(27 * 31).select((F.col("id") / 31).cast("long").alias("a"), (F.col("id") % 31).alias("b"))
    mixed = pairs.select("a", "b", pii.feistel(F.col("a"), F.col("b"), F.lit(27), F.lit(31), F.lit("t"), "k").alias("m")).collect()
    assert len({(r.m.a, r.m.b) for r in mixed}) == 27 * 31
    assert all(0 <= r.m.a < 27 and 0 <= r.m.b < 31 for r in mixed)


def test_sharding_cuts_fewer_pairs(spark):
    rows = [(i, f"text {i % 150}" if i % 3 else "everywhere") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    start, end = (sharding.cut_share(sharding.shard_documents(docs, n)).first() for n in (0, 4))
    assert start.pairs == end.pairs and end.cut_pairs < start.cut_pairs
    small = [sharding.shard_documents(docs, n).where("doc_id % 3 <> 0") for n in (0, 4)]
    cut = [sharding.cut_share(s).first().cut_pairs for s in small]
    assert cut[1] <= 0.6 * cut[0]  # no document is free here, so all moves are swaps


def test_archives(spark, workdir, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 4)
    same = "<p>" + "x" * 200
    pages = [(i, f"http://{'abc'[i % 3]}.Example.com:80/p?q={i}#f", f"<p>page {i}</p>" * 20) for i in range(40)]
    pages += [(50, "http://a.example.com/", same), (51, None, same), (52, "http://a.example.com/", same), (None, "x\r\ny", same)]
    pages += [(60, "u", None), (61, "u", ""), (62, "u", "short"), (63, "u", "short"), (64, "", "é" * 300), (40, "http://z/", same), (40, "http://z/", same)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string").repartition(3)
    got = warc.archive_round_trip(df, workdir).collect()
    import hashlib

    want = Counter()
    for i, _, html in pages:
        data = (html or "").encode()
        again = html == same and i != 40
        want[(i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 40 if again else None)] += 1
    assert Counter(tuple(r) for r in got) == want
    captures = warc.write_archives(df, f"{workdir}/w")
    index = warc.write_index(captures, f"{workdir}/i")
    one = captures.where("page_id = 7")
    found = warc.lookup(index, f"{workdir}/i", one).collect()
    assert len(found) == 1 and found[0].surt == "com,example,b)/p?q=7"
    assert warc.lookup(index, f"{workdir}/i", one.withColumn("surt", F.lit("none"))).count() == 0
    assert warc.archive_round_trip(df.where("false"), f"{workdir}/none").count() == 0
