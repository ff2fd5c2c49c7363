"""License scan, repeated passages, decontamination and SimHash against brute force."""

import hashlib
import random
import re
import textwrap

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from leadgrid.llm import decontam, licenses, losertree, queries, simhash, suffixes

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Columns whose names the operators use inside.
CLASH = "key long, body string, score double, label string, size long, shard int, words string"


def words(text):
    return WORDS.findall((text or "").translate(FOLD))


def documents(spark, rows):
    """Documents with clashing extra columns."""
    return spark.createDataFrame([(i, t, None, None, None, None, None, 7, None) for i, t in rows],
                                 f"doc_id long, text string, {CLASH}")


AWKWARD = [(None, None), (None, "under the MIT license"), (1, None), (2, ""), (3, " \n\t "), (4, "é" * 300),
           (4, "é" * 300), (5, "a b"), (6, "x" * 70_000 + " tail")]


def sorted_rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# --- licenses

def brute_license(text):
    flat = words(text)
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(flat) - len(p) + 1):
            if flat[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
    templates = [(label, set(words(t))) for label, texts in licenses.TEMPLATES.items() for t in texts]
    labels, best = set(base), 0.0
    lines = [words(line) for line in (text or "").split("\n")]
    for w in lines + [flat] * (len(lines) > 1):
        blocks = [w] if len(w) <= 32 else [w[i:i + 32] for i in range(0, len(w) - 16, 16)]
        for label, t in templates:
            for block in blocks:
                share = len(t & set(block)) / len(t)
                if share >= 0.8:
                    labels.add(label)
                    best = max(best, share)
    return (len(flat), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), 1.0 if base else best)


def test_license_scan_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [w for texts in licenses.TEMPLATES.values() for t in texts for w in t.split()] + ["zebra", "1", "Ünder"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 120))) for _ in range(150)]
    texts += ["Released UNDER the\nMIT-license.", "cc by nc by nc cc by nc", "Licensed under the GNU Public License, version 3",
              "Apache  License, Version 2.0 under the MIT license"]
    rows = AWKWARD + list(enumerate(texts, 100))
    got = licenses.license_scan(documents(spark, rows))
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert sorted_rows(got, *names) == sorted(((i, *brute_license(t)) for i, t in rows), key=repr)


def test_wrapped_notices_are_found(spark):
    notices = [("Redistribution and use in source and binary forms, with or without\nmodification, are permitted", "bsd"),
               ("licensed under the GNU General Public License\nversion 3", "gpl-3"),
               ("\n".join(licenses.TEMPLATES["mit"][0].split()), "mit"), ("licensed under the\n\nGNU", "")]
    rows = [(10 * i + at, "zebra\n" * at + text) for i, (text, _) in enumerate(notices) for at in range(10)]
    rows += [(100 * at, "zebra " * at + notices[0][0]) for at in range(1, 70)]
    got = {r["doc_id"]: (r["labels"], r["score"], r["n_blocks"]) for r in licenses.license_scan(documents(spark, rows)).collect()}
    for i, (_, label) in enumerate(notices):
        assert {got[10 * i + at] for at in range(10)} == {(label, 1.0 if label else 0.0, 0)}
    assert {got[100 * at][0] for at in range(1, 70)} == {"bsd"}


FULL_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files, to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the conditions below."""


@pytest.mark.parametrize("width", [20, 45, 96, 400])
def test_a_full_text_is_found_however_it_is_wrapped(spark, width):
    text = "some words before it\n" + textwrap.fill(" ".join(FULL_TEXT.split()), width) + "\nand after"
    german = "Lizenziert mit Freude.\nLicensed under the Apache License, Version 2.0, see the license"
    got = {r["doc_id"]: r["labels"] for r in licenses.license_scan(documents(spark, [(1, text), (2, german)])).collect()}
    assert got == {1: "mit", 2: "apache-2"}


def test_the_sql_twin_sees_wrapped_notices(spark):
    rng = random.Random(9)
    vocabulary = [w for texts in licenses.TEMPLATES.values() for t in texts for w in t.split()] + ["zebra"]
    rows = [(i, "".join(rng.choice(vocabulary) + rng.choice("  \n") for _ in range(rng.randint(0, 90)))) for i in range(60)] + [(99, None)]
    rows += [(200 + i, t.replace(" ", "\n", 1 + i % 7)) for i, t in enumerate(t for ts in licenses.TEMPLATES.values() for t in ts)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    twin = con.sql(queries.ORACLES["op1_license_scan"])
    got = licenses.license_scan(documents(spark, rows))
    assert sorted_rows(got, *twin.columns) == sorted(map(tuple, twin.fetchall()), key=repr)


def test_license_scan_of_nothing(spark):
    assert licenses.license_scan(documents(spark, [])).count() == 0


# --- repeated passages

def brute_repeats(rows):
    first = {}
    for i, t in sorted((i, (t or "").encode()) for i, t in rows if i is not None):
        for p in range(len(t) - 49):
            first.setdefault(t[p:p + 50], i)
    out = []
    for i, t in rows:
        t = (t or "").encode()
        gone = bytearray(len(t))
        if i is not None:
            for p in range(len(t) - 49):
                if first[t[p:p + 50]] < i:
                    gone[p:p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for p in range(len(gone)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé\x00 \n") for _ in range(200)) for _ in range(4)]
    rows = []
    for i in range(100):
        parts = []
        for _ in range(rng.randint(0, 4)):
            a = rng.randint(0, 150)
            parts += [rng.choice(base)[a:a + rng.randint(0, 120)], "".join(rng.choice("xy") for _ in range(rng.randint(0, 12)))]
        rows.append((rng.choice([None, rng.randint(-5, 60), i + 100]),
                     rng.choice([None, "", "a" * rng.randint(0, 150), "".join(parts), "".join(parts)])))
    return rows


@pytest.mark.parametrize("options", [{}, {"group_bytes": 3000}, {"group_bytes": 3000, "crowd": 2}])
def test_repeats_equal_brute_force(spark, options):
    rows = passages(3) + [(9000, "é" * 300), (9001, "é" * 300), (None, "é" * 300)]
    got = suffixes.remove_repeats(documents(spark, rows), with_text=False, **options)
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted_rows(got, *names) == brute_repeats(rows)


@pytest.fixture(params=[1, 4, 211])
def plain_partitions(spark, request):
    """The exchange keeps its partitions: nothing is coalesced at run time."""
    names = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("false", str(request.param))):
        spark.conf.set(n, v)
    yield request.param
    for n, v in zip(names, before):
        spark.conf.set(n, v)


@pytest.mark.parametrize("crowd", [4096, 3])
def test_repeats_on_any_number_of_partitions(spark, plain_partitions, crowd):
    """A gram in every document, many groups, and an exchange of 1, 4 or 211 partitions."""
    line = "every page repeats this line, which is longer than fifty bytes\n"
    rows = passages(5) + [(500 + i, line + (t or "")) for i, (_, t) in enumerate(passages(6))]
    got = suffixes.remove_repeats(documents(spark, rows), with_text=False, group_bytes=4000, crowd=crowd)
    assert sorted_rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(rows)


def test_repeats_return_the_kept_bytes(spark):
    passage = "the same passage stands in two documents and is longer than fifty bytes"
    got = suffixes.remove_repeats(documents(spark, [(1, passage), (2, "before " + passage + " after")]))
    assert {r["doc_id"]: bytes(r["kept"]) for r in got.collect()} == {1: passage.encode(), 2: b"before  after"}


def test_repeats_of_nothing(spark):
    assert suffixes.remove_repeats(documents(spark, [])).count() == 0


def test_equal_hashes_of_different_strings_are_told_apart(monkeypatch):
    text = b"".join(bytes([97 + i % 7]) for i in range(60)) + bytes(range(130, 190))
    data = np.frombuffer(text, np.uint8)
    keys = suffixes.unit_keys(data, np.array([0, 60]), np.array([3, 3]), np.array([5, 5]))
    monkeypatch.setattr(suffixes, "rolling", lambda x, width: np.zeros((len(x), x.shape[1] - width + 1), np.uint64))
    found = suffixes.smallest_documents(keys, np.array([4, 9]), np.array([0, 0]))
    assert found[0, :3].tolist() == [4, 4, 4] and found[1, :3].tolist() == [9, 9, 9]


def test_loser_trees_sort_like_sorted():
    rng = random.Random(1)

    def key():
        text = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 60)))
        return text + bytes(losertree.WIDTH - len(text) - 1) + b"\x01"

    for _ in range(15):
        runs = [sorted(key() for _ in range(rng.randint(0, 150))) for _ in range(rng.randint(1, 80))]
        flat = [k for run in runs for k in run]
        if not flat:
            continue
        keys = np.frombuffer(b"".join(flat), np.uint8).reshape(-1, losertree.WIDTH)
        ends = np.cumsum([len(r) for r in runs])
        lcp = np.concatenate([losertree.neighbour_lcp(losertree.as_words(keys[e - len(r):e])) for r, e in zip(runs, ends)])
        order, prefix = losertree.merge_runs(keys, lcp, [len(r) for r in runs])
        assert order.tolist() == sorted(range(len(flat)), key=lambda i: (flat[i], i))
        assert (prefix == losertree.neighbour_lcp(losertree.as_words(keys[order]))).all()


def test_front_coding_round_trip():
    rng = np.random.default_rng(2)
    keys = np.zeros((200, losertree.WIDTH), np.uint8)
    keys[:, :suffixes._USED] = rng.integers(97, 99, (200, suffixes._USED))
    keys = keys[np.argsort(losertree.as_strings(keys))]
    lcp = losertree.neighbour_lcp(losertree.as_words(keys))
    rest = keys[:, :suffixes._USED][np.arange(suffixes._USED) >= lcp[:, None]].tobytes()
    assert (suffixes.front_decoded(lcp, rest) == keys).all()


# --- decontamination

def brute_hits(text, items):
    flat, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        windows = [w[i:i + 10] for i in range(max(1, len(w) - 9))] if w else []
        for window in windows:
            for p in range(len(flat) - len(window) + 1):
                if flat[p:p + len(window)] == window:
                    hit.update(range(p, p + len(window)))
                    if item is not None:
                        found.add(str(item))
    names = ",".join(sorted(found))
    return len(flat), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0


def contaminated_rows():
    rng = random.Random(8)
    items = [(i, " ".join(rng.choice(["Ab", "cd,", "é", "7"]) for _ in range(rng.choice([0, 1, 3, 9, 10, 14, 25]))))
             for i in range(12)] + [(3, "one more text of item three"), (50, None)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, 5)
            parts += w[a:a + rng.randint(0, 30)] + [rng.choice(["zz", "Q Q", "--"])] * rng.randint(0, 2)
        texts.append("  ".join(parts))
    return items, AWKWARD + list(enumerate(texts, 100))


@pytest.mark.parametrize("block", [50_000, 20])
def test_decontamination_equals_brute_force(spark, block):
    items, rows = contaminated_rows()
    bench = spark.createDataFrame([(i, t, 1.0) for i, t in items + [(None, "no id so it counts for nothing")]],
                                  "item_id long, text string, key double")
    got = decontam.decontaminate(documents(spark, rows), bench, block_patterns=block)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = [(i, *brute_hits(t, items)) for i, t in rows]
    assert sorted_rows(got, *names) == sorted(want, key=repr)
    kept = decontam.keep_clean(documents(spark, rows), bench, block_patterns=block)
    assert sorted_rows(kept, "doc_id", "text") == sorted(((r[0], r[1]) for r, w in zip(rows, want) if not w[-1]), key=repr)


def test_spans_point_into_the_original_text(spark):
    text = "Été: ONE, two -- three! four"
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    row = decontam.decontaminate(documents(spark, [(1, text)]), bench).first()
    (span,) = row["spans"]
    assert text.encode()[span["start"]:span["stop"]].decode() == "ONE, two -- three"
    assert (span["first"], span["end"]) == (1, 4)


@pytest.mark.parametrize("block", [50_000, 1])
def test_items_without_an_id_contaminate(spark, block):
    bench = spark.createDataFrame([(None, "one two three"), (None, "five six"), (7, "five six")], "item_id long, text string")
    docs = documents(spark, [(1, "zero ONE two three"), (2, "four five six"), (3, "one two")])
    got = decontam.decontaminate(docs, bench, block_patterns=block)
    none, seven = (hashlib.sha256(x).hexdigest() for x in (b"", b"7"))
    assert sorted_rows(got, "doc_id", "n_hit", "n_items", "items_sha256", "contaminated") == [
        (1, 3, 1, none, True), (2, 2, 2, seven, True), (3, 0, 0, none, False)]  # as the SQL twin counts them
    assert sorted_rows(decontam.keep_clean(docs, bench, block_patterns=block), "doc_id") == [(3,)]


def test_decontamination_without_benchmark_or_documents(spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    got = decontam.decontaminate(documents(spark, AWKWARD), empty)
    assert not any(r["contaminated"] for r in got.collect())
    assert decontam.decontaminate(documents(spark, []), empty).count() == 0


# --- SimHash

def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark):
    rng = random.Random(4)
    base = [[rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(60)] for _ in range(12)]
    rows = list(AWKWARD)
    for i in range(120):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(60)] = "edit"
        rows.append((1000 - i, " ".join(w)))
    got = simhash.simhash_components(documents(spark, rows)).collect()
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    parent = {i: i for i, _ in prints if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in prints:
        for j, b in prints:
            if i is not None and j is not None and bin(a ^ b).count("1") <= 2:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    by_print = {}
    for i, f in prints:
        if i is not None:
            by_print[f] = min(by_print.get(f, i), root(i))
    want = [(i, f"{f:016x}", by_print.get(f)) for i, f in prints]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("crowd", [1, 4, 64])
def test_crowded_keys_lose_no_link(monkeypatch, crowd):
    monkeypatch.setattr(simhash, "_CROWD", crowd)
    rng = np.random.default_rng(6)
    entries = np.zeros(80, simhash._entry(0))
    entries["fp"] = rng.integers(0, 1 << 9, 80)
    entries["node"] = np.arange(80)
    forest = simhash.near_pairs(entries, 2, 0)
    near = np.bitwise_count(entries["fp"][:, None] ^ entries["fp"]) <= 2
    reach = near.copy()
    for _ in range(7):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    # The rows were sorted by key only, so places are nodes.
    assert [forest.root(i) for i in range(80)] == [int(np.flatnonzero(reach[i])[0]) for i in range(80)]


def test_near_duplicates_link_edited_copies_only(spark):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    texts = [[rng.choice(vocabulary) for _ in range(300)] for _ in range(30)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    for i in range(10):  # three edits in 300 words leave nine tenths of the shingles
        t = list(texts[i])
        for p in (20, 150, 280):
            t[p] = "edited"
        rows.append((100 + i, " ".join(t)))
    rows.append((200, " ".join(texts[20][:150] + texts[21][150:])))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    assert all(got[100 + i] == i for i in range(10))
    assert all(got[i] == i for i in range(30)) and got[200] == 200
    kept = simhash.keep_first(documents(spark, rows + [(None, rows[0][1])]))
    assert {r["doc_id"] for r in kept.collect()} == {200, *range(30)}  # the copy without an id goes, too
    assert kept.columns == documents(spark, []).columns


@pytest.mark.parametrize("top, segments, words, distance", [(0, 15, 4, 42), (1, 15, 4, 42), (5, 15, 4, 42), (17, 15, 4, 42),
                                                            (0, 19, 5, 55), (16, 19, 5, 55), (0, 16, 4, 45), (3, 16, 4, 45), (16, 16, 4, 45)])
def test_sketches_within_the_distance_always_meet(top, segments, words, distance):
    rng = np.random.default_rng(3)
    sketches = rng.integers(0, 1 << 63, (60, words), dtype=np.uint64)
    near = sketches.copy()
    for row in near:  # the most differing bits that link
        for bit in rng.choice(64 * words, distance, replace=False).tolist():
            row[bit // 64] ^= np.uint64(1 << bit % 64)
    kind, file = simhash._sketches(segments, top, words)
    batch = pa.RecordBatch.from_pydict({"node": list(range(120)), "sketch": [r.tobytes() for r in [*sketches, *near]]})
    forest = simhash.Forest()
    for blob in file([batch]):
        bucket, packed = blob.column("bucket")[0].as_py(), np.frombuffer(blob.column("blob")[0].as_py(), kind)
        for a, b in simhash.near_pairs(simhash.sketch_entries(packed, bucket, segments, top), 0, distance).links():
            forest.link(a, b)
    assert [forest.root(i) for i in range(120)] == [*range(60), *range(60)]


def test_appended_cut_and_replaced_copies_are_linked(spark):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(5000)]
    kinds = [lambda t, more: t + more[:72], lambda t, more: t[:-72], lambda t, more: t[:-36] + more[:36]]
    rows = []
    for i in range(120):
        text, more = ([rng.choice(vocabulary) for _ in range(600)] for _ in range(2))
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(kinds[i % 3](text, more)))]  # Jaccard 0.88 to 0.89
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    assert all(got[2 * i] == 2 * i for i in range(120))
    assert all(sum(got[2 * i + 1] == 2 * i for i in range(kind, 120, 3)) >= 37 for kind in range(3))


def test_simhash_of_nothing(spark):
    assert simhash.simhash_components(documents(spark, [])).count() == 0


def test_repeats_in_a_text_do_not_decide(spark):
    """A passage that fills half of a text by repeating neither links other texts nor parts edited copies."""
    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(5000)]
    passage = [rng.choice(vocabulary) for _ in range(10)] * 60
    rows = []
    for i in range(40):
        text = [rng.choice(vocabulary) for _ in range(600)]
        rows += [(2 * i, " ".join(text + passage)), (2 * i + 1, " ".join(text[:-70] + passage))]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    assert all(got[2 * i] == 2 * i for i in range(40)) and sum(got[2 * i + 1] == 2 * i for i in range(40)) >= 38


def test_the_sketch_starts_with_the_fingerprint():
    features = [f"word {i}".encode() for i in range(200)]
    assert simhash.simhash(features, 5)[:8] == simhash.simhash(features) and len(simhash.simhash(features, 5)) == 40
    assert simhash.sketch(b"", 5, 5) == bytes(40) == simhash.simhash([], 5)
    assert simhash.sketch_bits(0.8, 256) < 3 * 16  # a ball of radius 2 in one of 16 segments
