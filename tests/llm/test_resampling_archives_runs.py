"""Resampling, WARC archives and periodic runs against brute force and round trips."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sedimart.llm import periodic, queries, resample, warc

DOCS = "doc_id long, text string, lang string, key string, row long, score string"


def table(spark, texts):
    return spark.createDataFrame([(k, t, None, "clash", 1, "clash") for k, t in texts], DOCS)


# --- resampling

def brute_draw(texts, target, percent=10, least=20, buckets=10_000):
    def buckets_of(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return [zlib.crc32(w.encode()) % buckets for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]

    feats = [buckets_of(t) for _, t in texts]
    s, t = collections.Counter(b for f in feats for b in f), collections.Counter(b for x in target for b in buckets_of(x))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[i] + 1) * (s_all + buckets) / ((s[i] + 1) * (t_all + buckets)))) for i in range(buckets)]
    rows = []
    for (k, _), f in zip(texts, feats, strict=True):
        h = int(hashlib.sha256(f"2024:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((k, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted(((-r[3], r[0] is None, r[0] or 0), i) for i, r in enumerate(rows) if r[1] >= least)
    rank = {i: n + 1 for n, (_, i) in enumerate(fit[: percent * len(fit) // 100])}
    return collections.Counter((*r, rank.get(i)) for i, r in enumerate(rows))


def mixed_texts():
    draw = random.Random(7)
    words = [f"w{i}" for i in range(60)] + ["Été", "naïve", "42", "日本"]
    texts = [(i, draw.choice([" ", "-", "\n\t"]).join(draw.choices(words, k=draw.randint(0, 80)))) for i in range(300)]
    hot = " ".join(words[:25])
    return texts + [(900, hot)] * 150 + [(None, hot), (None, texts[0][1]), (901, None), (902, ""), (903, "W1 " * 20_000), (903, "a_b,c`d{e"), (904, "x" * 50_000)]


@pytest.mark.parametrize(("few", "chunk"), [(5, 16), (40, 65_536), (4_096, 65_536)])
def test_draws_equal_brute_force(spark, monkeypatch, few, chunk):
    monkeypatch.setattr(resample, "FEW", few)
    monkeypatch.setattr(resample, "CHUNK", chunk)
    texts, target = mixed_texts(), ["w1 w2 Été", "42 42", None]
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    got = resample.resample(table(spark, texts).repartition(5), benchmark)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert collections.Counter(map(tuple, got.collect())) == brute_draw(texts, target)


def test_draws_from_little(spark):
    empty = spark.createDataFrame([], "text string")
    assert resample.resample(table(spark, []), empty).count() == 0
    got = resample.resample(table(spark, [(1, "few words"), (2, None)]), empty).collect()
    assert sorted((r.doc_id, r.n_features, r["rank"]) for r in got) == [(1, 2, None), (2, 0, None)]
    pairs = resample.resample(table(spark, [(1, "a b c")]), empty, ngram=2, least_words=1, percent=100).collect()
    assert [(r.n_features, r["rank"]) for r in pairs] == [(5, 1)]


def test_task_medians_leave_an_eighth_on_either_side(monkeypatch):
    monkeypatch.setattr(resample, "CHUNK", 10)
    draw = np.random.default_rng(3)
    for n in (1, 7, 95, 400):
        down = draw.integers(0, 50, n)
        columns = [down, np.zeros(n, np.int64), np.arange(n), np.arange(n)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c[i : i + 7]) for c in columns], resample.Place.COLUMNS) for i in range(0, n, 7)]
        (out,) = resample._medians(iter(batches))
        middle = (out["down"][0].as_py(), 0, out["key"][0].as_py(), out["row"][0].as_py())
        keys = list(zip(*[c.tolist() for c in columns], strict=True))
        assert out["n"][0].as_py() == n and 8 * sum(k <= middle for k in keys) >= n and 8 * sum(k >= middle for k in keys) >= n


# --- archives

PAGES = "page_id long, url string, html string, body string, digest string"
LONG = "<p>ünï " * 9_000
BODIES = [
    (5, "http://a/é b?x=1\r\nWARC-Type: evil", "dup" * 50), (3, "http://b/", "dup" * 50), (3, "http://b/", "dup" * 50), (None, None, "dup" * 50), (7, "http://c", "short"), (8, None, "short"),
    (9, "u", None), (10, "u", ""), (11, "u", LONG), (12, "u", LONG), (13, "u", "x" * 99), (14, "u", "x" * 99), (15, "u", "x" * 100), (16, "u", "x" * 100), (17, "u", "a\r\n\r\nWARC/1.1\r\n0\r\n\r\n" * 9), (18, "u", "é" * 40_000),
]


def pages(spark):
    return spark.createDataFrame([(k, u, h, "clash", "clash") for k, u, h in BODIES], PAGES)


def wanted():
    out, owner = [], {}
    for k, _, h in sorted(BODIES, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (h or "").encode()
        first = owner.setdefault(raw, k) if len(raw) >= 100 else k
        seen = any(d == raw for d, *_ in [(o[5],) for o in out]) if len(raw) >= 100 else False
        out.append((k, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if seen else "response", first if seen else None, raw))
    return collections.Counter(r[:5] for r in out)


@pytest.mark.parametrize(("segment", "limit"), [(64, 200_000), (16_384, 0), (1 << 30, 0)])
def test_archives_round_trip(spark, tmp_path, segment, limit):
    folder = warc.write_archives(pages(spark), str(tmp_path / "warc"), segment=segment, limit=limit)
    got = warc.read_pages(spark, folder)
    rows = got.collect()
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == wanted()
    assert len({r.record_id for r in rows}) == len(rows) and all(r.damage is None for r in rows)
    whole = {(k, (h or "").encode()) for k, _, h in BODIES}
    assert all((r.page_id, bytes(r.payload)) in whole for r in rows if r.record_type == "response")
    records = warc.read_records(spark, folder)
    assert (records.filter("type = 'continuation'").count() > 0) == (segment < 1 << 30)
    assert records.agg(F.max(F.length("block"))).first()[0] <= max(segment, 200) or segment == 1 << 30
    assert {r.target_uri for r in records.filter("page_id = 5").collect()} == {"http://a/%C3%A9%20b?x=1%0D%0AWARC-Type:%20evil"}


def test_archives_of_no_rows_and_without_urls(spark, tmp_path):
    folder = warc.write_archives(pages(spark).filter("false"), str(tmp_path / "none"))
    assert warc.read_pages(spark, folder).count() == 0
    folder = warc.write_archives(pages(spark).select("page_id", "html"), str(tmp_path / "plain"))
    assert warc.read_pages(spark, folder, whole=False).filter("payload is null").count() == len(BODIES)


def test_damage_is_told(spark, tmp_path):
    page = {"key": 1, "row": 0, "url": "u", "body": "abc " * 200, "first_key": None, "first_row": None}
    records = list(warc.records_of(page, 200))
    end = b"\r\n\r\n"
    cases = {
        "segments are missing or repeated": records[:1] + records[2:],
        "segments do not add up to the total length": [*records[:-1], records[-1].replace(b"Total-Length: ", b"Total-Length: 1")],
        "payload differs from its digest": [records[0].replace(b"abc", b"abd"), *records[1:]],
    }
    for i, (damage, kept) in enumerate(cases.items()):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}" / "a.warc").write_bytes(b"".join(r + end for r in kept))
        assert [r.damage for r in warc.read_pages(spark, str(tmp_path / f"d{i}"), strict=False).collect()] == [damage]
        with pytest.raises(ValueError, match="damaged"):
            warc.read_pages(spark, str(tmp_path / f"d{i}"))
    revisit = next(warc.records_of(page | {"first_key": 9, "first_row": 4}))
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.warc").write_bytes(revisit + end)
    with pytest.raises(ValueError, match="missing or not equal"):
        warc.read_pages(spark, str(tmp_path / "r"))
    with pytest.raises(ValueError, match="cut short"):
        list(warc.parsed(records[0]))


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300), st.integers(4, 50))
def test_chunks_round_trip_between_characters(text, size):
    raw = text.encode()
    framed = warc.chunked(raw, size)
    assert warc.unchunked(framed) == raw
    framed.decode()
    assert b"".join(warc._cut(raw, size)) == raw and all(piece.decode() is not None and len(piece) <= size for piece in warc._cut(raw, size))


# --- periodic runs

def brute_runs(words, least=12):
    out = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(2 * p, least):
                out.setdefault((start, i + p), p)
    return sorted((s, p, e) for (s, e), p in out.items())


def test_cover_reaches_every_pair_of_places():
    assert all(((a + d) % 31 in periodic.COVER) and ((b + d) % 31 in periodic.COVER) for a in range(31) for b in range(31) for d in [periodic.DISTANCE[a, b]])


def test_common_extensions_equal_comparison():
    draw = np.random.default_rng(5)
    for words in (draw.integers(0, 2, 700), np.zeros(400, np.int64), np.tile(draw.integers(0, 9, 70), 9)):
        words = words.astype(np.int32)
        n = len(words)
        i = draw.integers(0, n - 1, 3000)
        j = np.minimum(i + draw.integers(1, n, 3000), n)
        want = [next((k for k in range(n - b) if words[a + k] != words[b + k]), n - b) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
        assert periodic.Extensions(words).common(i, j).tolist() == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=90), min_size=1, max_size=4), st.integers(2, 14))
def test_runs_equal_brute_force(texts, least):
    flat, want = [], []
    for k, words in enumerate(texts):
        want += [(s + len(flat), e + len(flat), p) for s, p, e in brute_runs(words, least)]
        flat += [*words, -2 - k]
    got = periodic.runs_of(np.array(flat, np.int32), max(map(len, texts)), least)
    assert sorted(map(tuple, got.tolist())) == sorted(want)


def test_documents_with_runs(spark, monkeypatch):
    monkeypatch.setattr(periodic, "WORDS", 300)
    monkeypatch.setattr(periodic, "PAIRS", 50)
    draw = random.Random(2)
    texts = [(i, draw.choice([" ", "\x0b\n"]).join(draw.choices("ab ", k=draw.randint(0, 60)))) for i in range(80)]
    texts += [(None, "x y " * 20), (None, None), (200, ""), (201, " \t"), (202, "same " * 5_000), (202, "same " * 5_000), (203, "A a " * 9)]
    got = periodic.periodic_runs(table(spark, texts)).collect()
    show = lambda k, w, runs, rest: (k, w, tuple(runs), rest)
    mine = collections.Counter(show(r.doc_id, r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed) for r in got)
    want = collections.Counter()
    for k, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "") if len(t or "") < 9_000 else t.split()
        runs = brute_runs(words) if len(words) < 900 else [(0, 1, len(words))]
        gone = {i for s, p, e in runs for i in range(s + p, e)}
        want[show(k, len(words), [(s, e - s, p) for s, p, e in runs], " ".join(w for i, w in enumerate(words) if i not in gone))] += 1
    assert mine == want
    assert periodic.periodic_runs(table(spark, [])).count() == 0


def test_query_of_runs_digests_them(spark, tmp_path):
    texts = [(i, " ".join(f"w{(i * j) % 37}" for j in range(150))) for i in range(60)] + [(None, "a " * 30), (1000, None), (1001, "one")]
    table(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op13_difference_cover_runs"](spark, str(tmp_path)).collect()}
    repeated = 0
    for k, t in texts:
        words = (t or "").split()
        h = zlib.crc32(str(k).encode()) if k is not None else 1
        if h % 10 == 0 and words:
            repeated += 1
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (r[2] - r[0], -r[0], -r[1]), default=None)
        gone = {i for s, p, e in runs for i in range(s + p, e)}
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        top = (best[0], best[2] - best[0], best[1], 1000 * (best[2] - best[0]) // best[1]) if best else (None,) * 4
        assert got[k] == (len(runs), *top, sha("".join(f"{s},{e - s},{p}\n" for s, p, e in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))
    assert repeated > 1
