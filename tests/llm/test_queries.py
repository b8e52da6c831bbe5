"""The registered queries on the small tables, against SQL or brute force."""

import base64
import hashlib
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from eventloom.llm import queries
from oracle import compare, connect
from test_operators import brute_components, brute_repeats, brute_rules, local, word_list

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def docs(spark):
    return local(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


@pytest.mark.parametrize("name", sorted(queries.load()[1]))
def test_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), SQL[name]) == []


def test_near_duplicates(spark, docs):
    assert Counter(map(tuple, QUERIES["op4_minhash"](spark, SF_DIR).collect())) == brute_components(docs)


def test_repeats(spark, docs):
    assert Counter(map(tuple, QUERIES["op5_repeats"](spark, SF_DIR).collect())) == brute_repeats(docs, 400)


def test_leaks(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    whole = {(i, item) for i, text in docs for item, passage in items if passage in (text or "")}
    got = {(r.doc_id, r.item_id): r.similarity for r in QUERIES["op3_decontamination"](spark, SF_DIR).collect()}
    assert whole and whole <= set(got)
    texts, passages = dict(docs), dict(items)
    for (i, item), similarity in got.items():
        assert similarity == pytest.approx(best_similarity(texts[i], passages[item])) and similarity >= 0.75


def test_sharding(spark, docs):
    """Each document goes to the shard with the best draw, one more shard takes what it draws best; slots are gapless."""

    def score(key, shard):
        seed = xxhash.xxh64_intdigest(struct.pack("<i", shard), seed=42)
        bits = xxhash.xxh64_intdigest(struct.pack("<q", key), seed=seed) >> 12
        return -1 / np.log((bits + 0.5) / float(1 << 52)), shard

    got = QUERIES["op9_sharding"](spark, SF_DIR).collect()
    want = Counter()
    for i, t in docs:
        best = max(score(i, shard) for shard in range(40))
        body = (t or "").encode()
        want[i, len(body) + 16, zlib.crc32(body), "key", best[1], max(best, score(i, 40))[1]] += 1
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law, r["shard"], r.grown_shard) for r in got) == want
    slots = Counter((r["shard"], r.slot) for r in got)
    sizes = Counter(r["shard"] for r in got)
    assert slots == Counter((shard, slot) for shard, n in sizes.items() for slot in range(n))


def test_pipeline(spark, docs):
    """The rows of the stages, each found by brute force on what the one before kept."""
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = local(frame)
        frame = stage(spark, frame, SF_DIR)
        if name == "near_dedup":
            kept = {i for (i, _, _, stays), _ in brute_components(before).items() if stays}
            assert {i for i, _ in local(frame)} == kept
    pieces = QUERIES["pipeline"](spark, SF_DIR)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {i for i, _ in local(frame)}


def brute_kept(rows):
    """Ids of the (id, text, source) rows that pass the rules and whose host does."""
    failed = []
    for _, text, _ in rows:
        want = brute_rules(text)
        failed.append(want[0] < 10 or 100 * want[4] > 20 * want[0])
    n = Counter(s for _, _, s in rows if s is not None)
    f = Counter(s for (_, _, s), bad in zip(rows, failed) if s is not None and bad)
    docs, mean = sum(n.values()), sum(f.values()) / sum(n.values())
    chance = mean * (1 - mean)
    spread = sum(f[s] ** 2 / n[s] for s in n) - docs * mean**2 - (len(n) - 1) * chance
    between = spread / (docs - sum(x * x for x in n.values()) / docs) if len(n) > 1 else 0
    weight = min(1e6, max(chance / between - 1, 0)) if between > 0 else 1e6
    bad_hosts = {s for s in n if (f[s] + mean * weight) / (n[s] + weight) > 0.5}
    return Counter(i for (i, _, s), bad in zip(rows, failed) if not bad and s not in bad_hosts)


def brute_lines(rows):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    owners = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            owners.setdefault(key(line), set()).add(i)
    out = Counter()
    for i, text in rows:
        parts = (text or "").split("\n")
        kept = [p for p in parts if len(key(p)) < 10 or i == min(owners[key(p)])]
        out[i, text if kept == parts else "\n".join(kept)] += 1
    return out


def best_similarity(text, passage):
    """Of all windows as long as the passage that share a shingle with it."""
    w, target = [x.lower() for x in word_list(text)], [x.lower() for x in word_list(passage)]

    def shingles(v):
        return [tuple(v[i : i + 5]) for i in range(max(1, len(v) - 4))] if v else []

    want, n = Counter(shingles(target)), len(target)
    width = min(n, 5)
    at = [i for i in range(len(w) - width + 1) if tuple(w[i : i + width]) in want] if n else []
    best = 0.0
    for low in {max(0, low) for i in at for low in range(i - n, i + 1)} | ({0} if n else set()):
        for high in {low + n} if low else range(1, n + 1):
            got = Counter(shingles(w[low:high]))
            best = max(best, sum((got & want).values()) / sum((got | want).values()))
    return best


def check_pieces(got, docs):
    """Pieces of the tokens of each text, side by side in sequences of 1,024."""
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(queries.public_tokenizer()[0])
    want = Counter()
    for key, text in docs:
        ids = [*exact.encode(text or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or min(len(ids), 1024), len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[key, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        ends = np.cumsum([n for _, n in sorted(spans)])
        assert [o for o, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 1024


def test_pipeline_decisions(spark):
    """What each stage keeps, by brute force on what the one before kept."""
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, sources = local(frame), [tuple(r) for r in frame.select("doc_id", "text", "source").collect()]
        frame = stage(spark, frame, SF_DIR)
        after = Counter(local(frame))
        if name == "quality_rules":
            assert Counter(i for i, _ in after.elements()) == brute_kept(sources) and 0 < len(after) < len(before)
        elif name == "line_dedup":
            assert after == brute_lines(before) != Counter(before)
            assert all(r.n_chars == len(r.text or "") for r in frame.collect())
        elif name == "near_dedup":
            kept = {i for (i, _, _, stays), _ in brute_components(before).items() if stays}
            assert after == Counter(r for r in before if r[0] in kept)
        else:
            assert after == Counter(r for r in before if all(best_similarity(r[1], t) < 0.75 for t in items)) != Counter(before)
    check_pieces(QUERIES["pipeline"](spark, SF_DIR).collect(), local(frame))


def test_packing_query(spark, docs):
    check_pieces(QUERIES["op1_packing"](spark, SF_DIR).collect(), docs)


def test_warc_query(spark, work):
    """The given pages, none of which is a copy, and copies of some of them under other ids and none."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    again = [F.col("page_id") + 1_000_000, -F.col("page_id") - 1, F.lit(None).cast("bigint")]
    for i, key in enumerate(again):
        pages = pages.unionByName(spark.read.parquet(f"{SF_DIR}/pages.parquet").where(f"page_id % {i + 2} = 0").withColumn("page_id", key))
    pages.write.parquet(f"{work}/pages.parquet")
    rows = [(r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{work}/pages.parquet").collect()]
    first, want = {}, Counter()
    for i, body in rows:
        if i is not None:
            first[body] = min(first.get(body, i), i)
    for i, body in rows:
        again = i is not None and first[body] < i
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want[i, len(body), digest, "revisit" if again else "response", first[body] if again else None] += 1
    assert Counter(map(tuple, QUERIES["op7_warc"](spark, work).collect())) == want
    assert any(kind == "revisit" for *_, kind, _ in want)


def test_classifier_query(spark, docs, monkeypatch):
    """The rows held out, the folds that the scores are made with, and the scores of the query."""
    given = {}

    def kept(*args, train, fold):
        given.update(train=train, fold=fold, scores=score(*args, train=train, fold=fold))
        return given["scores"]

    score = queries.score_documents
    monkeypatch.setattr(queries, "score_documents", kept)
    got = QUERIES["op10_classifier"](spark, SF_DIR).collect()
    third = {i: zlib.crc32(str(i).encode()) % 3 for i, _ in docs if i is not None}
    assert Counter((r.doc_id, r.held_out) for r in got) == Counter((i, third.get(i) == 1) for i, _ in docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sides = frame.where("doc_id IS NOT NULL").select("doc_id", given["train"].alias("t"), given["fold"].alias("f")).collect()
    assert all(r.t == (third[r.doc_id] != 1) and (r.f == (third[r.doc_id] != 0) or third[r.doc_id] == 1) for r in sides)


def test_classifier_tells_held_out_rows_apart(spark):
    """Of two held-out rows with different labels, the better one nearly always scores higher."""
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r.quality is not None}
    rows = [(r.score, labels[r.doc_id]) for r in QUERIES["op10_classifier"](spark, sf_dir).collect() if r.held_out and r.doc_id in labels]
    good, bad = (np.array([s for s, q in rows if q == kind]) for kind in (1, 0))
    assert len(good) > 20 and len(bad) > 5
    wins = (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2
    assert wins > 0.95
