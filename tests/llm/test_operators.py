"""Operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import base64
import gzip
import glob
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import chat, classifier, decontamination, lines, minhash, packing, quality, queries, repeats, sharding, warc
from eventloom.llm import words as W
from eventloom.llm.components import components

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
# Names that the operators use themselves.
CLASH = DOCS + ", kept BOOLEAN, n_words INT, row STRING, key STRING, hits INT, drop_pos STRING, version INT, host STRING"


def vocabulary(seed=0, n=400):
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 9))) for _ in range(n)]


def prose(draw, words, n):
    return " ".join(draw.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    draw, words = random.Random(1), vocabulary()
    base = [prose(draw, words, n) for n in (3, 12, 40, 90, 90, 200, 400)]
    shared = prose(draw, words, 110)
    out = [None, "", " \n\t", "one", "a b c d", "A B c d", *base, base[3], base[3].upper()]
    out += [base[4].replace(" ", "  ", 3) + " tail", f"x {shared} y", f"z {shared}", prose(draw, words, 30) + "\n" + shared]
    out += ["x" * 3000, "ab" * 1200, "é" * 900 + shared, prose(draw, words, 20_000), "same line here\n" * 4 + "Same Line HERE "]
    out += ["one more line\nsame line here\n\nlast", "w w w w w w w w w w w w", "#tag $x | y <b> & % *"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (7, "another text of a known id", None, None, 3), (None, rows[9][1], None, None, None)]
    return spark.createDataFrame([r + (True, 1, "r", "k", 2, "d", 3, "h") for r in rows], CLASH).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CLASH)


def local(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def word_list(text):
    return (text or "").encode().split()


def test_words():
    data = ["", "a", " a bc\x0bd ", "é x\n", "", "tail"]
    found = []
    for _, _, raw, offsets in W.chunks(pa.array(data), limit=6):
        start, end, bounds = W.find_words(raw, offsets)
        text = raw.tobytes()
        for a, b in zip(bounds[:-1], bounds[1:]):
            found.append([text[s:e] for s, e in zip(start[a:b], end[a:b])])
    assert found == [t.encode().split() for t in data]


def brute_rules(text):
    w, text = word_list(text), text or ""
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(5)}
    rows = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), len(rows) - len(set(rows)), len(covered)


def test_quality(docs, empty):
    got = quality.judged(docs).select("row.doc_id", "row.text", "row.source", *quality.COUNTS, "base_failed", "host_rejected", "kept").collect()
    assert len(got) == docs.count()
    for r in got:
        want = brute_rules(r.text)
        assert tuple(r[c] for c in quality.COUNTS) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed and not r.host_rejected) and not (r.source is None and r.host_rejected)
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(empty).count() == 0


def test_host_verdict(spark):
    """A bad host loses its good documents; one bad document does not condemn a small host among good ones."""
    good, bad = "these ten words are all different from each other here now", "bad"
    rows = [(i, good, None, f"h{i % 9}", 1) for i in range(180)]
    rows += [(1000 + i, bad if i else good, None, "spam", 1) for i in range(40)] + [(2000, bad, None, "tiny", 1), (2001, good, None, "tiny", 1)]
    got = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(rows, DOCS)).select("row.doc_id", "kept").collect()}
    assert not got[1000] and got[2001] and not got[2000] and all(got[i] for i in range(180))


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    model, ranks = queries.public_tokenizer()
    exact = Tokenizer.from_file(model)
    got = packing.pack_documents(docs, model, ranks).collect()
    want = Counter()
    for key, text in local(docs):
        ids = [*exact.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or min(len(ids), 1024)
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[key, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        ends = 0
        for offset, length in sorted(spans):
            assert offset == ends
            ends += length
        assert ends <= 1024
    assert packing.pack_documents(empty, model, ranks).count() == 0
    special = "a <|endoftext|> b"
    assert packing.encode(special, model, ranks).tolist() == exact.encode(special, add_special_tokens=False).ids


def test_local_search():
    """Swaps empty bins that best fit leaves: thirds of the room that only fit in the right company."""
    lengths = np.random.default_rng(3).integers(250, 420, 3000)
    plain = packing._Bins(1024)
    plain.best_fit(lengths.tolist())
    number, offset = packing.pack_lengths(lengths.tolist())
    assert number.max() + 1 < 0.95 * len(plain.items)
    assert np.bincount(number, lengths).max() <= 1024
    assert packing.pack_lengths([]) [0].tolist() == []


def test_line_dedup(spark, docs, empty):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    rows = local(docs)
    owners = {}
    for i, text in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                owners.setdefault(key(line), set()).add(i)
    want = Counter()
    for i, text in rows:
        parts = (text or "").split("\n")
        kept = [p for p in parts if i is None or len(key(p)) < 10 or len(owners[key(p)]) < 2 or i == min(owners[key(p)])]
        want[i, len(parts), len(parts) - len(kept), "\n".join(kept)] += 1
    for batches, fan_in in ((1, 3), (4, 2), (7, 2)):
        got = lines.drop_lines(docs, batches=batches, fan_in=fan_in).select("row.doc_id", "n_lines", "n_dropped", "kept_text")
        assert Counter(map(tuple, got.collect())) == want
    assert lines.drop_lines(empty).count() == 0
    parts = [docs.where("doc_id < 12"), docs.where("doc_id >= 12")]
    out = [d.select("row.doc_id", "n_lines", "n_dropped", "kept_text") for d in lines.add_batches(spark, parts)]
    assert sum((Counter(map(tuple, d.collect())) for d in out), Counter()) == Counter({k: n for k, n in want.items() if k[0] is not None})


def shingle_set(text):
    w = [x.lower() for x in word_list(text)]
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows, percent=75):
    keyed = [(i, shingle_set(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in keyed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(keyed):
        for j, t in keyed[:a]:
            if (i == j) or (s and t and 100 * len(s & t) >= percent * len(s | t)):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return Counter((i, len(s), find(i), i == find(i)) for i, s in keyed)


def near_copies():
    draw, words = random.Random(5), vocabulary(2)
    base = prose(draw, words, 60).split()
    out = []
    for i in range(90):
        copy = list(base)
        for _ in range(i % 5):
            copy[draw.randrange(60)] = draw.choice(words)
        out.append((1000 + i, " ".join(copy)))
    return out


@pytest.mark.parametrize("block", [512, 7])
def test_near_duplicates(spark, docs, empty, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = local(docs) + near_copies()
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    assert Counter(map(tuple, got.collect())) == brute_components(rows)
    if block == 512:
        assert minhash.near_duplicates(docs).count() == docs.where("doc_id IS NOT NULL").count()
        assert minhash.near_duplicates(empty).count() == 0


def test_components(spark):
    draw = random.Random(2)
    links = [(i, i + 1) for i in range(50)] + [(200, 100 + i) for i in range(30)] + [(5, 5)]
    draw.shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()))
    assert got == {**dict.fromkeys(range(51), 0), **dict.fromkeys([200, *range(100, 130)], 100)}


def test_min_max_is_unbiased():
    """Both ends of a permutation agree as often as the sets overlap."""
    draw = np.random.default_rng(4)
    agree = []
    for _ in range(60):
        x = draw.integers(0, 1 << 63, 400, dtype=np.uint64)
        sides = np.concatenate([np.sort(x[:300]), np.sort(x[100:])])
        a, b = minhash.min_max(sides, np.array([0, 300]))
        agree.append((a == b).mean())
    assert abs(np.mean(agree) - 0.5) < 0.02


def test_decontamination(spark, docs, empty):
    draw, words = random.Random(9), vocabulary(3)
    items = [(i, prose(draw, words, n)) for i, n in enumerate([1, 3, 6, 8, 10, 15, 37, 59, 300])] + [(90, None), (91, ""), (92, "")]
    rows, want = [], set()
    for i, (item, text) in enumerate(items[:9]):
        for shift in range(4):
            w = text.upper().split() if shift == 1 else text.split()
            if shift == 3 and len(w) > 30:
                w[len(w) // 2] = "edited"
            rows.append((100 * i + shift, prose(draw, vocabulary(7), 20 + shift) + "\n" + " ".join(w) + " " + prose(draw, vocabulary(8), 9)))
            want.add((100 * i + shift, item))
    rows += [(5000, None), (5001, ""), (5002, prose(draw, vocabulary(11), 20_000))]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    table = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    hits = decontamination.find_passages(frame, table).select("row.doc_id", F.explode("hits").alias("h")).select("doc_id", "h.item", "h.start", "h.similarity").collect()
    bodies, texts = dict(rows), dict(items)

    def exact(doc, item):
        """Best weighted similarity of any window as long as the item."""
        w, target = [x.lower() for x in word_list(bodies[doc])], [x.lower() for x in word_list(texts[item])]

        def counts(v):
            return Counter(tuple(v[i : i + 5]) for i in range(max(1, len(v) - 4)))

        want = counts(target)
        best = 0.0
        for i in range(len(w)):
            got = counts(w[i : i + len(target)])
            best = max(best, sum((got & want).values()) / sum((got | want).values()))
        return best

    found = {(h.doc_id, h.item) for h in hits}
    one_edit = {(d, i) for d, i in want if exact(d, i) < 0.75}
    assert want - one_edit <= found
    assert all(exact(d, i) >= 0.75 for d, i in found)
    assert decontamination.find_passages(docs, table).count() == docs.count()
    assert decontamination.find_passages(empty, table).count() == 0
    none = decontamination.find_passages(docs, table.where("false"))
    assert none.where(F.size("hits") > 0).count() == 0


def test_blocks_of_long_items(spark, docs, empty, monkeypatch):
    """No index holds more words than a block may, but for an item that has more by itself; the hits are the same."""
    draw, words = random.Random(14), vocabulary(10)
    items = [(i, prose(draw, words, n)) for i, n in enumerate([30, 60, 40, 300, 8, 50, 45, 5])] + [(90, None), (91, ""), (5, "one two three")]
    rows = [(i, f"{prose(draw, words, 9)} {items[i % 8][1]} {items[(i + 3) % 8][1]} {prose(draw, words, 9)}") for i in range(20)]
    rows += [rows[3], (None, items[1][1]), (30, None), (31, "")]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    table = spark.createDataFrame(items, "item_id BIGINT, text STRING").coalesce(1)

    def hits():
        return Counter((r.row.doc_id, r.row.text, tuple(map(tuple, r.hits))) for r in decontamination.find_passages(frame, table).collect())

    sizes = []

    class Counted(decontamination.Index):
        def __init__(self, ids, texts):
            super().__init__(ids, texts)
            sizes.append((len(ids), sum(map(len, self.words))))

    whole = hits()
    monkeypatch.setattr(decontamination, "Index", Counted)
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 100)
    assert hits() == whole and sum(map(len, (h for _, _, h in whole))) >= 40
    assert len(sizes) > 3 and all(n == 1 or words <= 100 for n, words in sizes)
    assert sum(n for n, _ in sizes) == 10
    found = decontamination.find_passages(docs, table)
    assert found.columns == ["row", "hits"] and found.count() == docs.count()
    assert found.select("row.*").columns == docs.columns
    assert decontamination.find_passages(empty, table).count() == 0


def test_hamming_radius():
    """Every pair within the radius is found."""
    draw = np.random.default_rng(6)
    prints = draw.integers(0, 1 << 63, 40, dtype=np.uint64)
    table = decontamination._Table(prints, np.arange(40), np.zeros(40, int))
    near, want = [], set()
    for i in range(400):
        bits = draw.choice(64, draw.integers(0, 11), replace=False)
        near.append(int(prints[i % 40]) ^ sum(1 << int(b) for b in bits))
    near = np.array(near, np.uint64)
    for i, p in enumerate(near):
        want |= {(i, int(j)) for j in np.flatnonzero(np.bitwise_count(prints ^ p) <= decontamination.RADIUS)}
    assert set(zip(*map(np.ndarray.tolist, table.near(near)))) == want


def brute_repeats(rows, length):
    windows = Counter(b[i : i + length] for _, t in rows for b in [(t or "").encode()] for i in range(len(b) - length + 1))
    out = Counter()
    for key, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if windows[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[key, len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("group", [4096, 2])
def test_repeats(docs, empty, spark, group):
    rows = [(i, t and t[:9000]) for i, t in local(docs)]
    columns = ["row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    got = repeats.without_repeats(frame, group=group).select(columns)
    assert Counter(map(tuple, got.collect())) == brute_repeats(rows, 400)
    near = near_copies()
    got = repeats.without_repeats(spark.createDataFrame(near, "doc_id BIGINT, text STRING"), length=60, gram=12, group=group).select(columns)
    assert Counter(map(tuple, got.collect())) == brute_repeats(near, 60)
    if group == 2:
        assert repeats.without_repeats(empty).count() == 0
        assert repeats.without_repeats(docs).count() == docs.count()


def test_repeats_of_a_long_text(spark, monkeypatch):
    """A text longer than a chunk is cut into parts that overlap."""
    monkeypatch.setattr(repeats, "_CHUNK", 4096)
    draw, words = random.Random(8), vocabulary(4)
    rows = [(1, prose(draw, words, 5000)), (2, prose(draw, words, 300))]
    rows.append((3, rows[0][1][3500:5500] + rows[1][1] + "é" * 5000))
    data = pa.array([t for _, t in rows])
    for row, _, raw, offsets in W.chunks(data, 4096):
        covered = np.zeros(max(len(raw) - 399, 0), int)
        for begin, part, bounds in repeats._pieces(raw, offsets, 400):
            _, _, _, first, _, last = repeats.find_anchors(part, bounds, 400, 32)
            for a, b in zip(first, last):
                covered[begin + a : begin + b + 1] += 1
        if len(offsets) == 2:
            assert (covered >= 1).all()


def test_maximal_repeats():
    """Groups of the tree against all substrings through the anchor."""
    draw = random.Random(3)
    for _ in range(40):
        n = draw.randint(2, 9)
        lefts = ["".join(draw.choice("ab") for _ in range(draw.randint(0, 6))).encode() for _ in range(n)]
        rights = ["G".encode() + "".join(draw.choice("ab") for _ in range(draw.randint(0, 6))).encode() for _ in range(n)]
        want = set()
        for a in range(7):
            for b in range(1, 8):
                same = {}
                for i in range(n):
                    if len(lefts[i]) >= a and len(rights[i]) >= b:
                        same.setdefault((lefts[i][len(lefts[i]) - a :], rights[i][:b]), []).append(i)
                for members in same.values():
                    before = {lefts[i][len(lefts[i]) - a - 1 :][:1] if len(lefts[i]) > a else i for i in members}
                    after = {rights[i][b : b + 1] or i for i in members}
                    if len(members) > 1 and a + b >= 4 and len(before) > 1 and len(after) > 1:
                        want.add((a, b, tuple(members)))
        got = {(a, b, tuple(sorted(m.tolist()))) for a, b, m in repeats.maximal_repeats(lefts, rights, 4)}
        assert got == want


def test_repeat_groups(spark):
    draw, words = random.Random(10), vocabulary(5)
    shared = prose(draw, words, 150)[:600]
    rows = [(i, prose(draw, words, 60) + f" {i}{i} {shared} {i}{i} " + prose(draw, words, 60)) for i in range(5)]
    found = repeats.repeat_groups(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    bodies = {i: t.encode() for i, t in rows}
    groups = {}
    for r in found:
        groups.setdefault((r.gram, r.repeat), []).append(bodies[r.key][r.start : r.start + r["size"]])
    assert groups and all(len(set(g)) == 1 and len(g) > 1 and len(g[0]) >= 400 for g in groups.values())
    assert any(len(g) == 5 for g in groups.values())


def brute_groups(rows, length, gram):
    """(size, occurrences) of the maximal repeats among all the ranges of each gram, by trying every part of every range."""
    at = {}
    for key, text in rows:
        data = text.encode()
        _, grams, _, first, anchor, last = repeats.find_anchors(np.frombuffer(data, np.uint8), np.array([0, len(data)]), length, gram)
        for g, a, b, c in zip(grams.tolist(), first.tolist(), anchor.tolist(), last.tolist()):
            at.setdefault(g, []).append((key, b, data[a:b], data[b : c + length]))
    out = Counter()
    for places in at.values():
        same = {}
        for i, (_, _, left, right) in enumerate(places if len(places) > 1 else []):
            for a in range(len(left) + 1):
                for b in range(max(gram, length - a), len(right) + 1):
                    same.setdefault((left[len(left) - a :], right[:b]), []).append(i)
        for (left, right), members in same.items():
            a, b = len(left), len(right)
            before = {places[i][2][len(places[i][2]) - a - 1 :][:1] if len(places[i][2]) > a else i for i in members}
            after = {places[i][3][b : b + 1] or i for i in members}
            if len(members) > 1 and len(before) > 1 and len(after) > 1:
                out[a + b, tuple(sorted((places[i][0], places[i][1] - a) for i in members))] += 1
    return out


@pytest.mark.parametrize("group", [4096, 2])
def test_repeat_groups_of_copies(spark, group):
    """Copies whose grams stand in other texts too are groups of their own, unless the others hold all their bytes."""
    draw, words = random.Random(13), vocabulary(9)
    base = prose(draw, words, 40)[:150]
    rows = [base] * 4 + [f"q{base[:120]} {prose(draw, words, 5)}", f"{prose(draw, words, 5)} {base[70:]}"]
    rows += [f"{prose(draw, words, 4)} {base} {prose(draw, words, 4)}", base[10:100] + "q", base[10:100] + "z"] * 2
    rows += [base[20:85] + x + prose(draw, words, 9) for x in "abab"]
    rows = [(i, t) for i, t in enumerate(rows)]
    found = repeats.repeat_groups(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3), length=60, gram=12, group=group).collect()
    groups = {}
    for r in found:
        groups.setdefault((r.gram, r.repeat, r["size"]), []).append((r.key, r.start))
    want = brute_groups(rows, 60, 12)
    assert max(len(places) for _, places in want) > 9
    assert Counter((size, tuple(sorted(places))) for (_, _, size), places in groups.items()) == want


PAGES = "page_id BIGINT, url STRING, html STRING, payload STRING, sha STRING"


@pytest.mark.parametrize("split", ["128m", "2k"])
def test_warc(spark, work, split):
    draw = random.Random(7)
    noise = "".join(chr(draw.randint(32, 1000)) for _ in range(30_000))
    rows = [(i, f"http://h/{i}\r\nX: y", draw.choice([noise[i * 50 : i * 90], "<p>same</p>", "", None]), "p", "s") for i in range(200)]
    rows += [(300, None, noise, "p", "s"), (3, "u", "<p>same</p>", "p", "s"), (None, "u", "<p>same</p>", "p", "s"), (301, "é", noise + "1", "p", "s")]
    warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), work)
    for path in glob.glob(f"{work}/part-*"):  # any gzip reader takes them
        with gzip.open(path) as file:
            assert file.read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc.read_archives(spark, work).where("record_type <> 'warcinfo'").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    first = {}
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        if i is not None:
            first[body] = min(first.get(body, i), i)
    want = Counter()
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        again = i is not None and first[body] < i
        name = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want[i, len(body), name, first[body] if again else None, None if again else body] += 1

    def page(value):
        tail = (value or "").rpartition(":")[2].rstrip(">")
        return int(tail) if value and "urn:page:" in value else None

    found = Counter(
        (page(r.headers["WARC-Record-ID"]), r.payload_bytes, r.payload_digest, page(r.headers.get("WARC-Refers-To")), None if r.payload is None else bytes(r.payload))
        for r in got
    )
    assert found == want


def test_warc_false_magic(spark, work):
    """Stored members full of magic bytes, and a record over several ranges."""
    bodies = [warc.MAGIC * 40 + bytes(range(256)) * 30 + warc.MAGIC, b"x" + warc.MAGIC * 9, bytes(5000) + warc.MAGIC]
    data = b""
    for i, body in enumerate(bodies * 3):
        packer = zlib.compressobj(0, zlib.DEFLATED, warc.GZIP)
        data += packer.compress(warc.record("resource", {"WARC-Record-ID": f"<{i}>"}, body)) + packer.flush()
    spark.createDataFrame([(bytearray(data[:-1]),)], "v BINARY").select(F.col("v").cast("string")).coalesce(1).write.text(work, lineSep="\0")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc.read_archives(spark, work).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert Counter(bytes(r.payload) for r in got) == Counter(bodies * 3)


def test_warc_empty(spark, work):
    warc.write_archives(spark.createDataFrame([], PAGES), work)
    assert warc.read_archives(spark, work).where("record_type <> 'warcinfo'").count() == 0


def test_template():
    draw = random.Random(1)
    bits = [*chat.CONTROLS, "\\", "\\\\", "\n", "x", "<", "[", "é", '"', "|>", "/"]
    for _ in range(500):
        turns = [("".join(draw.choices(bits, k=3)) if draw.random() < 0.3 else "assistant", "".join(draw.choices(bits, k=draw.randint(0, 9)))) for _ in range(draw.randint(0, 4))]
        text, spans = chat.format_turns(turns)
        assert chat.read_turns(text) == turns
        assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_reply_trees(spark):
    layout = "tree BIGINT, id BIGINT, up BIGINT, role STRING, text STRING, score DOUBLE, leaf INT, depth INT"
    rows = [(1, 1, None, "user", "a", 1.0), (1, 2, 1, "assistant", "b", 1.0), (1, 3, 1, "assistant", "c", 5.0), (1, 4, 3, None, None, None)]
    rows += [(2, i, i - 1 if i else 77, "user", str(i), 0.0) for i in range(70)]  # a chain whose first parent is missing
    rows += [(3, 1, 2, "user", "x", 1.0), (3, 2, 1, "user", "y", 1.0), (3, 3, 2, "user", "z", 1.0)]  # a circle with a tail
    rows += [(None, 1, None, "user", "x", 1.0), (4, None, None, "user", "x", 1.0)]
    frame = spark.createDataFrame([r + (0, 0) for r in rows], layout)
    args = ("tree", "id", "up", "role", "text", "score")
    got = {(r.tree, r.leaf): [(t.role, t.text) for t in r.turns] for r in chat.best_conversations(frame, *args).collect()}
    assert got == {(1, 4): [("user", "a"), ("assistant", "c"), ("", "")], (2, 69): [("user", str(i)) for i in range(70)]}
    both = chat.best_conversations(frame, *args, best=2).where("tree = 1").orderBy(F.desc("score")).collect()
    assert [(r.leaf, r.score) for r in both] == [(4, 2.0), (2, 1.0)]
    assert chat.read_back(chat.formatted(chat.best_conversations(frame.where("false"), *args))).count() == 0


def test_sharding(spark, docs, empty):
    layout = "doc_id BIGINT, shard STRING, Slot INT, extra STRING"
    rows = [(i, "a", 1, "x") for i in range(4000)] + [(7, "a", 1, "x")] * 5000 + [(None, None, None, None)] * 3
    got = sharding.assign_shards(spark.createDataFrame(rows, layout), ["doc_id"], [1.0] * 9 + [3.0])
    assert set(got.columns) == {"doc_id", "extra", "shard", "slot", "grown_shard"}
    got = got.collect()
    assert len(got) == len(rows) and Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    slots, shard = {}, {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r.slot)
        assert shard.setdefault(r.doc_id, r["shard"]) == r["shard"]
        assert r.grown_shard in (r["shard"], 10)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = Counter(s for k, s in shard.items() if k is not None)
    assert all(240 < sizes[s] < 430 for s in range(9)) and 850 < sizes[9] < 1150
    grown = {r.doc_id: r.grown_shard for r in got}
    again = sharding.assign_shards(spark.createDataFrame(rows[:4000], layout), ["doc_id"], [1.0] * 9 + [3.0, 1.0]).collect()
    assert all(grown[r.doc_id] == r["shard"] for r in again)
    assert sharding.assign_shards(empty, ["doc_id"], [1.0] * 4).count() == 0
    assert sharding.assign_shards(docs, ["doc_id"], [1.0]).count() == docs.count()
    with pytest.raises(ValueError):
        sharding.assign_shards(docs, ["doc_id"], [])


def test_isotonic():
    n, total = np.array([1.0, 2, 1, 1]), np.array([1.0, 0, 0, 1])
    assert classifier.isotonic(n, total).tolist() == [0.25, 0.25, 0.25, 1.0]


def test_classifier(spark, docs, empty):
    draw, words = random.Random(12), vocabulary(6)
    rows = []
    for i in range(600):
        w = prose(draw, words, draw.randint(5, 200)).split()
        rows.append((i, " ".join(x + draw.choice("#$%") for x in w) if i % 3 == 0 else " ".join(w), "en", "s", 1))
    frame = spark.createDataFrame(rows, DOCS).unionByName(docs.select("doc_id", "text", "lang", "source", "n_chars").withColumn("doc_id", F.col("doc_id") + 10_000))
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(600)] + [(5, None), (None, 1), (99_999, 1)], "doc_id BIGINT, quality INT")
    train, fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1, F.col("doc_id") % 2
    got = classifier.score_documents(frame, labels, train, fold).collect()
    assert len(got) == frame.count() and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 3 != 0) for r in held]) > 0.97
    assert {r.score for r in classifier.score_documents(frame, labels.where("false"), train, fold).collect()} == {0.5}
    assert {r.score for r in classifier.score_documents(frame, labels.where("quality = 1"), train, fold).collect()} == {1.0}
    assert classifier.score_documents(empty, labels, train, fold).count() == 0


def test_pipeline_stages(spark, docs, empty):
    """Every stage takes odd rows and other columns, and keeps the columns."""
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count()
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0
    assert corpus_pipeline.packing(spark, empty, "/root/testdata/sf0.001").count() == 0
