"""Tokenizer alignment, whitening and url filters against brute force."""

import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import alignment, lines, queries, urls, whitening

SF_DIR = "/root/testdata/sf0.001"


# -- alignment


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return alignment.Vocabulary(*queries.public_tokenizer(), public_tokenizers.path("piece_bpe_32k.model"))


def by_hand(texts, vocabulary):
    """Tokens, groups and links by spans of every token; counts over all texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(vocabulary.model_a)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=vocabulary.model_b)
    chars = alignment._byte_of_char()

    def spans(ids, as_bytes):
        out, at = [], 0
        for i in ids:
            width = len(as_bytes(i))
            out.append((i, at, at + width))
            at += width
        return out

    def bytes_a(i):
        return bytes(chars[c] for c in a_model.id_to_token(i))

    def bytes_b(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()

    found = []
    for text in texts:
        a, b = [], []
        if text:
            a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
            want = (" " + text).encode()
            if b"".join(map(bytes_a, a)) != want or b"".join(map(bytes_b, b)) != want:
                a, b = [], []
        sa, sb = spans(a, bytes_a), spans(b, bytes_b)
        links, first = [], 0
        for i, s, e in sa:
            while first < len(sb) and sb[first][2] <= s:
                first += 1
            k = first
            while k < len(sb) and sb[k][1] < e:
                links.append((i, sb[k][0]))
                k += 1
        common = sorted({e for *_, e in sa} & {e for *_, e in sb})
        own = [[[] for _ in common], [[] for _ in common]]
        for side, into in zip((sa, sb), own):
            for i, _, e in side:
                into[bisect.bisect_left(common, e)].append(str(i))
        groups = [f"{','.join(x)}|{','.join(y)}" for x, y in zip(*own)]
        found.append((a, b, links, groups))
    counts = Counter(pair for *_, links, _ in found for pair in links)
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for a, b, links, groups in found:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        best = sum(counts[p] == top[p[1]] for p in links)
        out.append((len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return out, counts


def odd_texts():
    draw = random.Random(4)
    words = ["the", "naïve", "Straße", "日本語", "x1y2", "can't", "  ", "\n", "\t\t", "🙂", "e\u0301", "ﬁne", "<|endoftext|>", "</s>", "antidisestablishmentarianism", "0", "1234567"]
    texts = [" ".join(draw.choice(words) for _ in range(n)) for n in (1, 2, 5, 30, 120)]
    texts += [None, "", " ", "\n", "a", "▁", "a▁b", "<0x41>", "x" * 2100, "\x00\x01", texts[3], texts[3], "  two  spaces ", "é" * 40]
    return texts


COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize(("piece", "bound"), [(1 << 14, None), (1, None), (7, 5), (50, 40)])
def test_alignment(spark, vocabulary, monkeypatch, piece, bound):
    texts = odd_texts()
    want, counts = by_hand(texts, vocabulary)
    if bound:
        monkeypatch.setattr(alignment, "BROADCAST_ROWS", bound)
    rows = [(i if i != 3 else None, t, "n") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, number STRING").repartition(3)
    got, pairs = alignment.align_tokenizers(docs, vocabulary, piece=piece)
    got = got.select("row.doc_id", "row.text", "row.number", *COUNTS).collect()
    assert Counter(map(tuple, got)) == Counter((*r, *w) for r, w in zip(rows, want))
    assert {(r.a, r.b): r["count"] for r in pairs.collect()} == counts


def test_alignment_of_nothing(spark, vocabulary):
    texts, pairs = alignment.align_tokenizers(spark.createDataFrame([], "doc_id BIGINT, text STRING"), vocabulary)
    assert texts.collect() == [] and pairs.collect() == []


def test_alignment_query(spark, vocabulary):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want, _ = by_hand([r.text for r in rows], vocabulary)
    got = {tuple(r) for r in queries.alignment(spark, SF_DIR).select("doc_id", *COUNTS).collect()}
    assert got == {(r.doc_id, *w) for r, w in zip(rows, want)}


def test_crossing_cuts_evenly():
    draw = np.random.default_rng(3)
    for _ in range(50):
        a, b = (np.unique(draw.integers(1, 60, draw.integers(1, 40))) for _ in range(2))
        merged = sorted([(e, 0) for e in a] + [(e, 1) for e in b])
        for d in range(len(merged) + 1):
            i, j = alignment.crossing(a, b, d)
            assert (i, j) == (sum(s == 0 for _, s in merged[:d]), sum(s == 1 for _, s in merged[:d]))


# -- whitening


def whitened_by_hand(rows, components=8):
    """(n, components up to sign, variances, trace, deviations, whitened) by the singular values of all rows."""
    x = np.floor(1024 * np.array(rows, np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    _, singular, basis = np.linalg.svd(centred, full_matrices=False)
    values, basis = singular**2 / n, basis.T
    z = centred @ basis[:, :components] / np.sqrt(values[:components])
    far = [sum(int(v) ** 2 for v in n * row - sums) for row in x]
    return n, basis[:, :components].T, values, values.sum(), far, z


def agree(got, want):
    sign = np.sign((got * want).sum(axis=0))
    return np.abs(got * sign - want).max()


@pytest.mark.parametrize("scales", [np.linspace(3, 0.5, 12), 10.0 ** np.arange(3, -2.5, -0.5)])
def test_whitening(spark, scales):
    draw = np.random.default_rng(5)
    mix = np.linalg.qr(draw.normal(size=(len(scales), len(scales))))[0]
    good = (draw.normal(size=(700, len(scales))) * scales @ mix + 50).tolist()
    good += good[:3]
    bad = [None, [], [1.0], good[0][:-1], [*good[0][:-1], None], [*good[0][:-1], float("nan")], [*good[0][:-1], float("-inf")], [*good[0][:-1], 1e30]]
    rows = [(i, v, "x") for i, v in enumerate(good)] + [(None, v, "y") for v in bad]
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, deviation STRING").repartition(5)
    fitted = whitening.fit_whitening(frame)
    n, basis, values, trace, far, z = whitened_by_hand(good)
    assert fitted.n == n and fitted.identity_error < 1e-9
    assert np.allclose(fitted.variances, values[:8], rtol=1e-9) and np.isclose(fitted.total_variance, trace, rtol=1e-12)
    out = sorted(whitening.whitened(frame, fitted).select("row.vec_id", "deviation", "whitened", "row.deviation").collect())
    assert [r[0] for r in out] == list(range(n))
    assert [int(r[1]) for r in out] == far
    assert agree(np.array([r[2] for r in out]), z) < 1e-6


@pytest.mark.parametrize("width", [1, 3, 20])
def test_whitening_of_dependent_dimensions(spark, width):
    """Constant, repeated and summed dimensions give components for the directions that vary alone."""
    draw = np.random.default_rng(6)
    free = draw.integers(-500, 500, size=(300, width)) / 1024
    rows = np.column_stack([free, np.full(300, 0.25), free[:, :1], free[:, 0] + free[:, -1]])
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows.tolist())], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    fitted = whitening.fit_whitening(frame)
    assert len(fitted.components) == min(width, 8)
    values = whitened_by_hand(rows.tolist())[2]
    assert np.allclose(fitted.variances, values[: len(fitted.variances)], rtol=1e-9)
    assert fitted.identity_error < 1e-9
    assert np.allclose(fitted.components @ fitted.components.T, np.eye(len(fitted.components)), atol=1e-12)


def test_whitening_without_variation(spark):
    kind = "vec_id BIGINT, embedding ARRAY<FLOAT>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 4):
        frame = spark.createDataFrame(rows, kind)
        fitted = whitening.fit_whitening(frame)
        out = whitening.whitened(frame, fitted).collect()
        usable = [r for r in rows if r[1]]
        assert [(int(r.deviation), r.whitened) for r in out] == [(0, [])] * len(usable)


def test_exact_deviations():
    draw = np.random.default_rng(7)
    for most in (10, 10**6, 2**40):
        x = draw.integers(-most, most, size=(40, 9))
        for n in (1, 40, 10**7, 10**12):
            sums = [int(v) * n // 40 + 1 for v in x.sum(axis=0)]
            want = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
            assert list(map(int, whitening._deviations(x, n, sums))) == want


def test_whitening_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").orderBy("vec_id").collect()
    n, _, values, trace, far, z = whitened_by_hand([r.embedding for r in rows])
    got = sorted(queries.whitening(spark, SF_DIR).collect(), key=lambda r: (r.vec_id, r.component))
    assert [(r.vec_id, r.component) for r in got] == [(r.vec_id, c) for r in rows for c in range(1, 9)]
    assert {r.n for r in got} == {n} and [r.deviation for r in got[::8]] == far
    assert agree(np.array([r.whitened for r in got]).reshape(n, 8), z) < 1e-9
    assert np.allclose([r.explained for r in got[:8]], values[:8] / trace, rtol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


# -- url filters


def verdict_by_hand(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        tail = rest[end:]
        if tail.startswith("/"):
            path = tail[: min([i for i in (tail.find(c) for c in "?#") if i >= 0], default=len(tail))]
    fits = []
    for rule_host, rule_path, verdict in rules:
        if rule_host is None or verdict not in ("allow", "block"):
            continue
        rule_host, rule_path = "".join(c.lower() if c.isascii() else c for c in rule_host), rule_path or ""
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            fits.append((len(rule_host + rule_path), len(rule_host), verdict == "block", rule_host + rule_path))
    if not fits:
        return host, path, None, default
    best = max(fits)
    return host, path, best[3], "block" if best[2] else "allow"


def odd_urls():
    draw = random.Random(8)
    labels = ["a", "b", "www", "Example", "É", "x-y"]
    urls_ = [
        f"http{draw.choice(['', 's'])}://{'.'.join(draw.choice(labels) for _ in range(draw.randint(1, 4)))}"
        f"{draw.choice(['', '/', '/a', '/a/', '/a/b', '/a/bc/', '/ab/c?d=/e', '?q=/a', '#/a', '/é/ü', '//a//'])}"
        for _ in range(300)
    ]
    return urls_ + [None, "", "a/b", "://", "http://", "http:///a", "x://a.b://c/d", "http://.a/", "http://a./a", "http://a.b:80/a/", "http://a.b/\n/a", urls_[0], "http://a.b" + "/a" * 4000, "http://" + "a." * 4000 + "b/a/"]


RULES = [
    ("a", "/", "allow"), ("a.b", "/a", "block"), ("A.B", "/a/", "allow"), ("b", "/a/b", "block"), ("b", "", "block"), ("www.example", "/ab/c", "block"),
    ("example", "/a/", "block"), ("example", "/a/", "allow"), ("É", "/é", "block"), ("x-y", None, "block"), ("", "/a", "block"), (None, "/", "block"), ("a", "/a", "maybe"), ("b", "a", "block"),
    ("a", "//a/", "block"),
]


@pytest.mark.parametrize("bound", [None, 2])
def test_url_verdicts(spark, monkeypatch, bound):
    if bound:
        monkeypatch.setattr(urls, "BROADCAST_ROWS", bound)
    rows = [(i % 290, u, "h") for i, u in enumerate(odd_urls())]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, host STRING").repartition(3)
    rules = spark.createDataFrame(RULES, "host STRING, path STRING, verdict STRING")
    got = urls.url_verdicts(pages, rules).select("row.page_id", "row.url", "row.host", "host", "path", "rule", "verdict").collect()
    assert Counter(map(tuple, got)) == Counter((*r, *verdict_by_hand(r[1], RULES)) for r in rows)


def test_url_verdicts_without_rules_or_urls(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id BIGINT, url STRING")
    rules = spark.createDataFrame(RULES, "host STRING, path STRING, verdict STRING")
    got = urls.url_verdicts(pages, rules.limit(0), default="block").select("host", "path", "rule", "verdict").collect()
    assert list(map(tuple, got)) == [("a.b", "/c", None, "block")]
    assert urls.url_verdicts(pages.limit(0), rules).collect() == []


def test_url_plan_is_native(spark):
    plan = queries.url_filters(spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- runs of lines


def test_runs_meet_without_exchange(spark):
    """A batch that is dealt out like the runs meets them, and runs are merged, bucket by bucket."""
    runs = lines.LineRuns(spark, fan_in=3)

    def dealt(ids):
        return ids.select(F.xxhash64("id").alias("line_a"), F.xxhash64("id", F.lit(1)).alias("line_b")).repartition(runs.buckets, "line_a", "line_b")

    for low in (0, 500, 900):
        runs._push(runs.unseen(spark.table(runs._write(dealt(spark.range(low, low + 700))))))
    for low in (1500, 100):
        runs._push(runs.unseen(spark.table(runs._write(dealt(spark.range(low, low + 200))))))
    assert [len(level) for level in runs.levels] == [2, 1]
    assert sum(run.count() for run in runs.runs()) == 1700
    batch = spark.table(runs._write(dealt(spark.range(1600, 2000))))
    spark.conf.set(lines._FILE_ORDER, "true")
    try:
        found = runs.unseen(batch)
        assert found.count() == 300
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (found, runs.merged(*runs.levels[0]))]
    finally:
        spark.conf.set(lines._FILE_ORDER, "false")
    for plan in plans:
        assert "SortMergeJoin" in plan and "Sort " not in plan and "Exchange" not in plan
    runs.close()
