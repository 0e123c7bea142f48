"""Ranked search, packages of WARC records, and spelling variants: brute force, round trips and edge cases."""

import gzip
import hashlib
import io
import json
import math
import os
import random
import re
import zipfile
from collections import Counter
from datetime import datetime
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinsync.llm import ranked_search, spelling, warc, zip_archive
from twinsync.session import work_folder

TIME = datetime(2024, 1, 1)
CLASHES = ("item", "term", "n", "path", "offset", "word", "score", "rank", "_key", "_refers_to", "record_type", "id")


def clashing(df):
    return df.withColumns({c: F.lit("extra") for c in CLASHES})


# Ranked search.


def terms_of(text):
    return re.findall(r"[0-9A-Za-z\x80-\U0010FFFF]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, top):
    """Straight from the definition of the score."""
    counted = [(i, Counter(terms_of(text))) for i, text in docs]
    counted = [(i, c) for i, c in counted if c]
    total, length = len(counted), sum(c.total() for _, c in counted)
    df = Counter(term for _, c in counted for term in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counted:
            m = 10 + (90 * c.total() * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(terms_of(text)) if c[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def found_in(spark, docs, items, **options):
    left = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    right = spark.createDataFrame(items, "item_id string, text string")
    found = ranked_search.search(clashing(left), clashing(right), **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score", "item"]
    return sorted((tuple(r)[:4] for r in found.collect()), key=repr)


def test_search_against_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(words[min(int(rng.paretovariate(0.6)) - 1, 59)] for _ in range(n))
    docs = [(i, text(rng.randint(0, 40))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(50)]  # ties beyond the k-th place
    items = [(f"q{i}", text(rng.randint(1, 25))) for i in range(20)]
    for options in ({}, {"group_terms": 15}):
        assert found_in(spark, docs, items, **options) == ranked(docs, items, 10)
    assert found_in(spark, docs, items, top=3) == ranked(docs, items, 3)


def test_search_over_blocks(spark, monkeypatch):
    """Blocks that carry the k-th score on give what one block gives."""
    rng = np.random.default_rng(1)
    queries = [ranked_search._Query(0, np.arange(5), np.array([900, 500, 300, 40, 3]))]
    n, terms = 400, 5
    dense = (rng.random((terms, n)) < np.array([[0.02], [0.1], [0.3], [0.8], [1.0]])) * rng.integers(1, 9, (terms, n))
    whole = (dense * queries[0].weights[:, None]).sum(0)

    def block(part):
        docs = [np.flatnonzero(row) for row in part]
        impacts = np.concatenate([row[d] for row, d in zip(part, docs)])
        starts = np.append(0, np.cumsum([len(d) for d in docs]))
        return ranked_search._Block(np.arange(part.shape[1]), starts, np.concatenate(docs), impacts, part.max(1))

    floor = 0
    for at in range(0, n, 100):
        scores, places = ranked_search.search_block(queries[0], block(dense[:, at:at + 100]), 10, floor)
        assert (scores == whole[at + places]).all()  # survivors are exact
        missed = np.setdiff1d(np.arange(100), places)
        best = np.sort(whole[at:at + 100])[-10]
        assert (whole[at + missed] < max(best, floor, 1)).all()
        floor = max(floor, int(best))
        assert len(places) < 100  # accumulators were limited


def test_search_edges(spark):
    long = " ".join(f"t{i} common" for i in range(30000))
    docs = [
        (1, None), (2, ""), (3, " .,;\n"), (4, "common été"), (4, "common été"), (None, "common été"), (5, long),
        (6, "COMMON É 7"), (7, "common été"),
    ]
    items = [("a", "Common, été!"), ("a", "Common, été!"), (None, "t5 t17 t29999"), ("b", None), ("c", ""), ("d", "absent")]
    assert found_in(spark, docs, items) == ranked(docs, items, 10)
    assert found_in(spark, docs, items, top=2) == ranked(docs, items, 2)
    assert found_in(spark, [], items) == [] and found_in(spark, docs, []) == []


# Packages.


PAGES = [
    (1, "http://a/1", "x" * 1000), (2, "http://a/2", "x" * 1000), (9, "http://a/9", "x" * 1000), (3, None, "x" * 999),
    (4, "http://a/4", "x" * 999), (5, "http://a/5\r\nevil: 1", None), (6, "http://a/6", ""), (7, "u", "é" * 500),
    (8, "v", "é" * 500), (8, "v", "é" * 500), (None, "w", "é" * 500), (None, "z", "\r\n\r\nWARC/1.1 \x00 PK\x05\x06"),
    (10, "long", "<p>0123456789</p>" * 200_000),
]


def page_rows(spark, rows=PAGES):
    return clashing(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2))


def expected_digests(pages):
    out = []
    for page_id, _, html in pages:
        payload = (html or "").encode()
        ids = [i for i, _, other in pages if (other or "") == (html or "") and i is not None]
        refers = max(ids) if len(payload) >= 1000 and ids and max(ids) != page_id else None
        kind = "response" if refers is None else "revisit"
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), kind, refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"wide": True}, {"package_bytes": 1}])
def test_packages_round_trip(spark, options):
    manifest = warc.write_packages(page_rows(spark), work_folder(spark, "packages"), TIME, **options)
    assert manifest.agg(F.sum("records")).first()[0] == len(PAGES)
    assert (manifest.count() == len(PAGES)) == ("package_bytes" in options)
    records = warc.read_records(manifest)
    assert sorted(map(tuple, warc.page_digests(records).collect()), key=repr) == expected_digests(PAGES)
    held = {r["record_id"]: r for r in records.collect() if r["record_type"] == "response"}
    assert held["<urn:page:10>"]["payload"].decode() == PAGES[-1][2]
    assert held["<urn:page:5>"]["target_uri"] == "http://a/5 evil: 1"
    for row in manifest.collect():  # an independent reader takes them too
        with zipfile.ZipFile(row["path"].removeprefix("file://")) as package:
            assert package.testzip() is None
            data = gzip.decompress(package.read("archive/data.warc.gz"))
            assert data.count(b"WARC-Record-ID: ") == row["records"]
            assert len(package.read("indexes/index.cdx").splitlines()) == row["records"]


def test_pages_as_read_and_none(spark):
    found = warc.package_and_read(page_rows(spark), TIME)
    assert sorted(map(tuple, found.collect()), key=repr) == expected_digests(PAGES)
    none = warc.package_and_read(page_rows(spark, []), TIME)
    assert none.columns == found.columns and none.isEmpty()


def plain_record(urn, payload):
    head = {"WARC-Type": "response", "WARC-Record-ID": urn, "Content-Type": "application/http"}
    return warc.record_bytes(head, b"HTTP/1.1 200 OK\r\n\r\n" + payload)


def test_packages_of_others(spark, tmp_path):
    """Made by another writer: no index, an index of several archives, compressed members, damage."""
    one, two = plain_record("<urn:a>", b"first"), plain_record("<urn:b>", b"second")

    def package(name, members, method=zipfile.ZIP_STORED, comment=b""):
        with zipfile.ZipFile(tmp_path / name, "w", method) as out:
            for member, data in members.items():
                out.writestr(member, data)
            out.comment = comment
        return str(tmp_path / name)

    line = lambda name, at, size: f'x 2024 {json.dumps({"filename": name, "offset": at, "length": size})}\n'.encode()
    packed = [gzip.compress(one), gzip.compress(two)]
    index = line("p.warc.gz", len(packed[0]), len(packed[1])) + b"no json\n" + line("q.warc", 0, len(one)) + line("gone", 0, 1)
    whole = package("a.wacz", {"archive/p.warc.gz": b"".join(packed), "archive/q.warc": one, "indexes/i.cdx.gz": gzip.compress(index)})
    paths = [
        whole,
        package("b.wacz", {"archive/p.warc.gz": b"".join(packed), "archive/q.warc": one + two}, comment=b"PK\x05\x06 in a comment"),
        package("c.wacz", {"archive/p.warc": one * 50, "x.txt": b"x"}, zipfile.ZIP_DEFLATED),
        package("d.wacz", {}),
    ]
    (tmp_path / "e.wacz").write_bytes(b"no archive")
    (tmp_path / "f.wacz").write_bytes(b"")
    data = (tmp_path / "a.wacz").read_bytes()
    (tmp_path / "g.wacz").write_bytes(data[:len(data) // 2])
    paths += [str(tmp_path / f"{c}.wacz") for c in "efg"]
    rows = warc.read_records(clashing(spark.createDataFrame([(p,) for p in [*paths, paths[0], None]], "p string").select("p")).drop("path").withColumnRenamed("p", "path")).collect()

    def of(name):
        mine = [r for r in rows if r["path"].endswith(name)]
        return sorted(bytes(r["payload"]) for r in mine if r["payload"] is not None), sorted(r["problem"] for r in mine if r["problem"])

    assert of("a.wacz") == ([b"first", b"second"], ["an index names gone, which is not among the stored members", "unreadable line of an index"])
    assert of("b.wacz") == ([b"first", b"first", b"second", b"second"], [])
    assert of("c.wacz") == ([], ["archive/p.warc is compressed or encrypted as a whole"])
    assert of("d.wacz") == ([], [])
    assert [len(of(f"{c}.wacz")[1]) for c in "efg"] == [1, 1, 1] and of("g.wacz")[0] == []


def test_one_package_is_read_by_many_tasks(spark):
    pages = spark.range(200).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.expr("repeat(md5(string(id)), 40)").alias("html"))
    manifest = warc.write_packages(pages.coalesce(1), work_folder(spark, "packages"), TIME)
    assert manifest.count() == 1
    tasks = warc.read_records(manifest, share_bytes=2000).where("problem is null").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 5 and sum(r["count"] for r in tasks) == 200


def test_directories_of_64_bits():
    """Sizes and places beyond 32 bits, told by the directory alone."""
    out = io.BytesIO()
    writer = zip_archive.ZipWriter(out)
    writer.start("archive/a.warc")
    writer.write(b"abc")
    writer.finish()
    writer.members = [m._replace(name=f"archive/{i}.warc", header=m.header + i * 2**33, size=2**32 + i) for m in writer.members for i in range(3)]
    writer.close()
    read = list(zip_archive.members(out, len(out.getvalue()), chunk=7))
    assert read == writer.members
    assert zip_archive.data_start(out, read[0]) == out.getvalue().index(b"abc")
    many = io.BytesIO()
    writer = zip_archive.ZipWriter(many)
    for i in range(70000):
        writer.start(str(i))
        writer.finish()
    writer.close()
    assert [m.name for m in zip_archive.members(many, len(many.getvalue()))] == [str(i) for i in range(70000)]


# Spelling.


def variants(docs, slip=199, min_count=5):
    """Straight from the definition: every word against every string one edit away."""
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            key = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip and key % slip == 0:
                run = run[:key % len(run)] + run[key % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= min_count}
    letters = {c for w in n for c in w}

    def near(w):
        cut = [w[:i] + w[i + 1:] for i in range(len(w))]
        put = [w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters]
        new = [w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters]
        return {x for x in (*cut, *put, *new) if x != w and x in n}

    all_near = {w: near(w) for w in n}
    form = {}
    for w, others in all_near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(all_near[w]), form[w], n.get(form[w]), root))
    return sorted(out)


def grouped(spark, docs, **options):
    df = clashing(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3))
    found = spelling.group_variants(df, **options)
    assert found.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(map(tuple, found.collect()))


def test_spelling_against_brute_force(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcà") for _ in range(rng.randint(5, 9))) for _ in range(25)]

    def changed(w):
        spot = rng.randrange(len(w))
        return rng.choice([w[:spot] + w[spot + 1:], w[:spot] + rng.choice("abcà") + w[spot:], w[:spot] + "b" + w[spot + 1:], w, w, w, w, w])

    docs = [(i, " ".join(changed(rng.choice(words)).title() for _ in range(60))) for i in range(150)]
    for slip in (199, 7, 0):
        expected = variants(docs, slip)
        assert grouped(spark, docs, slip=slip) == expected
        assert sum(r[3] is not None for r in expected) > 20


def test_roots_follow_forms_to_the_last(spark):
    chain = ["abcdef", "abcdeg", "abcdhg", "abcihg", "abjihg", "akjihg"]
    text = " ".join(" ".join([w] * (5 * 6**i)) for i, w in enumerate(chain))
    found = {r[0]: r for r in grouped(spark, [(1, text)], slip=0)}
    assert [found[w][3] for w in chain] == [*chain[1:], None]
    assert {r[5] for r in found.values()} == {chain[-1]}


def test_spelling_edges(spark):
    long = "seventh " * 40000 + "sevenths " * 6
    docs = [
        (1, None), (2, ""), (3, "12 ..."), (4, long), (None, "seventy " * 6), (5, "Éclair " * 5), (5, "Éclair " * 5),
        (6, "éclair " * 5), (7, "aaaaaa " * 5 + "aaaaaaa " * 25), (8, "a×b÷cd " * 5), (9, "\U0001f600 short " * 9),
    ]
    assert grouped(spark, docs) == variants(docs)
    assert grouped(spark, []) == []
    with pytest.raises(ValueError):
        spelling.group_variants(spark.createDataFrame([], "doc_id bigint, text string"), ratio=1)


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(2)
    for _ in range(300):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(6, 12)))
        grams = sorted({word[i:i + 2] for i in range(len(word) - 1)} | {a + b for a in "abcd" for b in "abcd"})
        costs = sorted((rng.randint(1, 50), g) for g in grams)
        ranks = {g: (i, n) for i, (n, g) in enumerate(costs)}
        prefix = spelling.prefix_of(word, ranks)
        pivots = spelling.choose_pivots(prefix, ranks)
        assert len(pivots) == 2 and pivots[1][0] - pivots[0][0] >= 2 and set(pivots) <= set(prefix)
        pairs = [(a, b) for a in prefix for b in prefix if b[0] - a[0] >= 2]
        assert sum(ranks[g][1] for _, g in pivots) == min(ranks[a[1]][1] + ranks[b[1]][1] for a, b in pairs)
