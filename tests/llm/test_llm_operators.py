"""Operators on small tables with nulls, repeats, ties, empty tables and clashing column names."""

import gzip
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docloom.llm import langid, licenses, lm_score, mixing, multi_index, omh, packing, toxicity, vafile, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, class_id long, size int, row string, component string"
LABELS = "doc_id long, quality int, toxic int, score double"
WORDS = {"en": "the of and to in is was that for with on are by this from", "de": "der die und nicht ein ist mit auf für sich dem den von zu im"}


def _text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split()) + str(rng.integers(0, 3)) * int(rng.random() < 0.1) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(160):
        lang = "en" if i % 3 else "de"
        text = _text(rng, lang, int(rng.integers(30, 90)))
        if i % 8 == 5:
            text = text.replace(" the ", " you idiot ").replace(" die ", " du idiot ", 2) + " idiot moron"
        rows.append((i, text, lang, f"s{i % 3}" if i % 10 else None, len(text)))
        labels.append((i, i % 2, int(i % 8 == 5), 0.0))
    base = rows[1][1]
    words = _text(rng, "en", 60).split()
    words = [f"{w}{j}" for j, w in enumerate(words)]
    near = words.copy()
    near[30] = "changed"
    extra = [" ".join(words), " ".join(near), " ".join(words).upper() + "!", base, "", "   ", None, "12 34 !!", "a b", "a b", "word " * 30_000]
    rows += [(200 + i, t, "en", "s0", 0) for i, t in enumerate(extra)]
    rows += [(200, " ".join(words), "en", "s0", 0), (None, "no id here", "en", None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame([(*r, 0.0, 0, 0, "r", "c") for r in rows], DOCS)
    labels += [(None, 1, 1, 0.0), (3, None, None, 0.0), (5, 1, 1, 0.0)]
    return docs, spark.createDataFrame(labels, LABELS), rows


def _empty(spark):
    return spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)


def test_near_duplicates(spark, tables):
    docs, _, rows = tables
    got = omh.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r["class_id"] for r in got}
    assert by[200] == by[201] == by[202] == 200 and by[203] == by[1] == 1
    assert [by[i] for i in (204, 205, 206, 207, 208, 209)] == [204, 205, 206, 207, 208, 208] and by[None] is None
    kept = omh.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(200) == 1 and 201 not in ids and ids.count(None) == 2
    assert omh.near_duplicates(_empty(spark)[0]).count() == 0


def test_a_chain_of_near_copies_is_one_class(spark):
    """Every text is near the next one only; classes are those of all pairs by brute force."""
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(12):
        rows.append((i, " ".join(words)))
        for at in range(10 * i, 10 * i + 10):
            words[at] = f"x{i}_{rng.integers(1 << 30)}"
    got = {r["doc_id"]: r["class_id"] for r in omh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hashed = [omh.word_hashes(t) for _, t in rows]
    near = {(i, j) for i in range(12) for j in range(i) if omh.similar(hashed[i], hashed[j], 0.8) is not None}
    assert (1, 0) in near and (11, 0) not in near
    assert set(got.values()) == {0}


def test_near_duplicates_agree_with_all_pairs(spark):
    """Ties, ids with two texts, a passage in every text and blocks of a few rows; by brute force over all pairs."""
    rng = np.random.default_rng(4)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for i in range(60):
        words = [f"w{i // 4}_{j}" for j in range(120)] if i % 2 else [f"w{i // 4}_{j}" for j in range(30)]
        for at in rng.choice(len(words), len(words) // 20, replace=False):
            words[at] = f"x{i}_{at}"
        rows.append((i, f"{passage} {' '.join(words)}" if i % 3 else " ".join(words)))
    rows += [(0, "another text under the same id that is near the next one by far"), (70, "another text under the same id that is near the next one by now"), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = [(i, omh.word_hashes(t)) for i, t in rows]
    root = {i: i for i, _ in rows}
    for i, a in hashed:
        for j, b in hashed:
            if i != j and omh.similar(a, b, 0.8) is not None and root[i] != root[j]:
                lo, hi = sorted((root[i], root[j]))
                root = {k: lo if r == hi else r for k, r in root.items()}
    for p in (omh.OmhParams(), omh.OmhParams(block=4)):
        got = {r["doc_id"]: r["class_id"] for r in omh.near_duplicates(docs, p).collect()}
        assert got == root
    # both texts of the kept id stay, the repeated row and the near copy go
    kept = [tuple(r) for r in omh.keep_one(docs).filter("doc_id in (0, 70)").collect()]
    assert sorted(kept) == sorted(set(r for r in rows if r[0] == 0))


def test_top_k(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(120, 6)).astype(np.float32)
    rows = [(i, v.tolist(), 0.0) for i, v in enumerate(x)] + [(500, None, 0.0), (501, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0.0), (502, [float("nan")] * 6, 0.0), (503, [float("inf")] * 6, 0.0), (504, [1.0], 0.0), (None, x[0].tolist(), 0.0), (60, x[60].tolist(), 0.0)]
    rows += [(600 + i, x[7].tolist(), 0.0) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double").withColumns({"x": F.lit("clash"), "row": F.lit(1), "b": F.lit(2), "qb": F.lit(None), "code": F.lit("c")})
    got = {}
    for r in vafile.top_k(df, F.col("vec_id") % 20 == 0, vafile.VaParams(k=7, cells=8, block=50, query_block=3)).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    z = np.floor(64 * x.astype(np.float64)).astype(int)
    every = [*((i, z[i]) for i in [*range(120), 60]), *((600 + i, z[7]) for i in range(150))]
    queries = [*range(0, 120, 20), *range(600, 750, 20)]
    for query in queries:
        want = sorted((-int(dict(every)[query] @ v), i) for i, v in every if i != query)[:7]
        assert [got[query][k] for k in range(1, 8)] == [(i, -s) for s, i in want]
    assert set(got) == set(queries)
    assert vafile.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_packing(spark, tables):
    docs, _, rows = tables
    got = packing.pack(docs.repartition(3)).collect()
    spans = {}
    for r in got:
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in spans.values():
        total = 0
        for off, n in sorted(own):
            assert off == total
            total += n
        assert total <= 1024 and (total == 1024 or total & (total - 1) == 0)
    p = packing.PackParams()
    assert sum(r["length"] for r in got) == sum(len(packing.token_ids(r[1] or "", p)) for r in rows)
    text = {r[0]: r[1] or "" for r in rows}
    for r in got[:200]:
        if r["doc_id"] is not None:
            ids = packing.token_ids(text[r["doc_id"]], p)
            assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].astype("<u4").tobytes())
    assert packing.pack(_empty(spark)[0]).count() == 0


def test_related_documents_meet_wherever_they_stand(spark):
    """Pairs with a word of their own, far apart in the table, share a window although the table is many shards."""
    rng = np.random.default_rng(2)
    common = ["river", "mill", "bridge", "road", "town", "field"]
    rows = [(i, " ".join([*rng.choice(common, 30), *[f"zq{i % 40}xv"] * 6])) for i in range(80)]
    rows += [(100 + i, "hot topic again and again " * 8) for i in range(60)] + [(200, "one long text " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = packing.pack(docs, packing.PackParams(window=128, shard_docs=16, shard_tokens=4000)).collect()
    shard = {}
    for r in got:
        shard.setdefault(r["doc_id"], set()).add(r["sequence_id"] >> 32)
    assert sum(bool(shard[i] & shard[i + 40]) for i in range(40)) >= 36
    assert len({s for i in range(100, 160) for s in shard[i]}) >= 3 and len({s for v in shard.values() for s in v}) >= 8
    assert sum(r["length"] for r in got) == sum(len(packing.token_ids(t, packing.PackParams())) for _, t in rows)


def _components(ids, links):
    root = {i: i for i in ids}
    for _ in ids:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_embedding_links(spark):
    rng = np.random.default_rng(0)
    rows = []
    for g in range(30):
        c = rng.normal(size=16)
        for k in range(int(rng.integers(1, 8))):
            rows.append((len(rows), (c + rng.normal(size=16) * 0.2).tolist(), g % 3))
    rows += [(900, rows[0][1], rows[0][2]), (901, rows[0][1], None), (902, None, 0), (903, [0.0] * 16, 0), (904, [float("nan")] * 16, 0), (905, rows[0][1][:3], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("mult", F.lit("clash"))
    got = {r["vec_id"]: r for r in multi_index.near_duplicates(df).collect()}
    good = [(i, np.array(v), g) for i, v, g in rows if i is not None and g is not None and v is not None and len(v) == 16 and np.isfinite(v).all() and np.any(v)]
    links = [(a, b) for a, x, g in good for b, y, h in good if a != b and g == h and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93]
    assert len(got) == len(rows) and links
    found = sum(r["n_links"] for r in got.values())
    assert 0.9 * len(links) <= found <= len(links)
    if found == len(links):
        root = _components([i for i, _, _ in good], links)
        assert all(got[i]["component_id"] == root[i] and got[i]["kept"] == (root[i] == i) for i in root)
    assert [got[i]["n_links"] for i in (901, 902, 903, 904, 905, None)] == [0] * 6 and got[902]["component_id"] == 902
    assert multi_index.near_duplicates(df.limit(0)).count() == 0


def test_embedding_links_by_brute_force(spark):
    """Text and long labels, floats, scaled and repeated vectors, and an id with two vectors: every link and component."""
    rng = np.random.default_rng(8)
    rows = []
    for g in range(12):
        c = rng.normal(size=8)
        for k in range(40):
            rows.append((len(rows), (c + rng.normal(size=8) * 0.15).astype(np.float32).tolist(), f"label {g % 2}"))
    rows += [(3, rows[300][1], "label 1"), (3, rows[3][1], "label 0"), (1000, [8 * x for x in rows[5][1]], "label 0"), (1001, [-0.0, *rows[6][1][1:]], "label 0"), (1002, [0.0, *rows[6][1][1:]], "label 0")]
    x = np.array([v for _, v, _ in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = np.array([a[2] for a in rows])
    link = (x @ x.T >= 0.93) & (same[:, None] == same) & ~np.eye(len(rows), dtype=bool)
    root = np.arange(len(rows))
    for _ in rows:
        root = np.minimum(root, np.where(link, root, len(rows)).min(1))
    least = {r: min(rows[i][0] for i in np.flatnonzero(root == r)) for r in set(root)}
    want = sorted((r[0], int(link[i].sum()), least[root[i]], least[root[i]] == r[0]) for i, r in enumerate(rows))
    p = multi_index.MultiIndexParams(rows_per_cell=16, block=16, recall=0.999)
    for kind, shift in (("string", 0), ("long", 1 << 40)):
        label = F.col("label") if kind == "string" else F.regexp_extract("label", "[0-9]", 0).cast("long") + shift
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string").withColumn("label", label)
        got = sorted(tuple(r) for r in multi_index.near_duplicates(df, p).collect())
        assert [g[0] for g in got] == [w[0] for w in want]
        assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want) and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
        assert sum(g[2:] == w[2:] for g, w in zip(got, want, strict=True)) >= 0.98 * len(want)


def test_toxicity(spark, tables):
    docs, labels, rows = tables
    got = toxicity.score(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(160)}
    assert all(r["held_out"] == held[r["doc_id"]] for r in got if r["doc_id"] is not None and r["doc_id"] < 160)
    right = [r["predicted"] == (r["doc_id"] % 8 == 5) for r in got if r["doc_id"] is not None and r["doc_id"] < 160 and held[r["doc_id"]]]
    assert np.mean(right) >= 0.9
    none = toxicity.score(docs, _empty(spark)[1]).agg(F.max("score")).first()[0]
    assert none == 0 and toxicity.score(*_empty(spark)).count() == 0
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and 0.8 * len(rows) < kept.count() < len(rows)


def test_licences(spark, tables):
    lines = [
        "Licensed under the Apache License, Version 2.0.", "some text\nReleased under the MIT License.\nmore", "All rights reserved.", "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under CC BY-NC 4.0.", "A license plate was found near the road.", "the seller reserved a table for the general public", None, "", "Released under the MIT License.\nLicensed under the Apache License, Version 2.0.",
    ]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*lines, lines[0]])] + [(None, lines[0], "x")], "doc_id long, text string, family string")
    got = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    assert [got[i]["family"] for i in range(5)] == ["apache", "mit", "proprietary", "gpl", "cc-by-nc"]
    assert [got[i]["family"] for i in range(5, 9)] == [None] * 4
    assert got[9]["families"] == ["apache", "mit"] and got[9]["paragraphs"] == 2 and got[10]["family"] == got[None]["family"] == "apache"
    repeated = licenses.scan(df.filter("doc_id = 1").unionByName(df.filter("doc_id = 1"))).collect()
    assert len(repeated) == 2 and {r["paragraphs"] for r in repeated} == {1}
    assert licenses.scan(df.limit(0)).count() == 0
    plan = licenses.scan(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


def test_cross_entropy_matches_brute_force(spark, tables):
    docs, labels, rows = tables
    p = lm_score.LmParams()
    some = docs.filter("doc_id < 40 or doc_id is null or doc_id in (204, 206)")
    got = {r["doc_id"]: r for r in lm_score.score(some, labels).collect() if r["doc_id"] is not None}
    text = {r[0]: r[1] or "" for r in rows if r[0] is not None and (r[0] < 40 or r[0] in (204, 206))}
    every = [*text.values(), "no id here", ""]
    good = [text[i] for i in text if i < 160 and i % 2 == 1]

    def counts(texts):
        out = [dict() for _ in range(p.order)]
        for t in texts:
            cells = lm_score.codes(t, p)
            for k in range(p.order):
                for c in cells[k].tolist():
                    out[k][c] = out[k].get(c, 0) + 1
        return out

    target, background = counts(good), counts(every)
    share = sum(target[0].values()) / sum(background[0].values())
    background = [{c: n * share for c, n in t.items()} for t in background]

    def loss(t, tables_):
        cells, total = lm_score.codes(t, p), sum(tables_[0].values())
        contexts, out = lm_score.context_codes(cells, p), 0.0
        for i in range(len(cells[0])):
            prob = (tables_[0].get(int(cells[0][i]), 0) + p.smoothing / 256) / (total + p.smoothing)
            for k in range(1, p.order):
                n = tables_[k].get(int(cells[k][i]), 0)
                prob = (n + p.smoothing * prob) / (max(tables_[k - 1].get(int(contexts[k - 1][i]), 0), n) + p.smoothing)
            out -= np.log(prob)
        return out / len(cells[0])

    for i in (0, 1, 2, 3, 204, 206):
        want = loss(text[i], target) - loss(text[i], background)
        assert got[i]["score"] == pytest.approx(want, abs=1e-4) and got[i]["n_tokens"] == len(text[i].encode()) + 1
    assert all(r["score"] == 0 for r in lm_score.score(some, _empty(spark)[1]).collect())
    assert lm_score.score(*_empty(spark)).count() == 0


def test_language(spark, tables):
    docs, _, rows = tables
    got = langid.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    held = [by[i]["lang_pred"] == ("en" if i % 3 else "de") for i in range(160) if by[i]["held_out"]]
    assert np.mean(held) > 0.95
    assert [by[i]["lang_pred"] for i in (204, 205, 206, 207)] == ["und"] * 4 and by[204]["score"] == 0
    assert langid.identify(_empty(spark)[0]).count() == 0
    assert langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct().first()[0] == "und"
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= set(range(160))


def test_mixing(spark, tables):
    docs, _, rows = tables
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    size = {}
    for _, t, _, s, _ in rows:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted((s for s in size if s is not None)) + [None]
    want = mixing.targets(np.array([size[s] for s in order]), np.array([[3.0, 1.0, 2.0][i % 3] for i in range(len(order))]), 1.5 * sum(size.values()), 2.0)
    for s, t in zip(order, want, strict=True):
        own = [r for r in got if r["source"] == s]
        assert own[0]["target"] == pytest.approx(t) and own[0]["source_size"] == size[s]
        assert sum(r["taken"] for r in own) == pytest.approx(t, abs=40)
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)
    key = lambda rs: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in rs)
    assert key(mixing.mix(docs.repartition(5)).collect()) == key(got)
    assert mixing.mix(_empty(spark)[0]).count() == 0
    drawn = mixing.draw(docs)
    assert drawn.columns == docs.columns and drawn.groupBy("doc_id").count().filter("doc_id < 160").agg(F.max("count")).first()[0] <= 2
    # whole documents, each source within half a document of its quota per shard
    for s, t in zip(order, want, strict=True):
        own = drawn.filter(F.col("source").eqNullSafe(F.lit(s))).select("text").collect()
        words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in own)
        longest = max(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows if r[3] == s)
        assert abs(words - t) <= longest / 2 + 40
    # a third of all rows is one row without an id
    same = docs.limit(0).unionByName(docs).unionByName(docs.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")).crossJoin(docs.sparkSession.range(100)).drop("id"))
    got = mixing.mix(same).filter("doc_id is null").groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.max("taken").alias("hi"), F.min("taken").alias("lo")).orderBy(F.desc("n")).first()
    assert got["n"] == 100 and got["hi"] - got["lo"] <= 1 and got["hi"] <= 2 * got["size"]
    assert mixing.draw(same).columns == docs.columns
    many = mixing.mix(docs, mixing.MixParams(shard_docs=7)).groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("g")).collect()
    assert all(abs(r["t"] - r["g"]) < 200 for r in many)


def test_warc(spark, tmp_path):
    big, other = "é" * 700, "b" * 1000
    rows = [(1, "http://a", big), (2, "http://b c", big), (3, None, big), (4, "u", other), (5, "u", "small"), (6, "u", "small"), (7, "u", None), (8, "u", ""), (3, "u", big), (None, "u", big)]
    pages = spark.createDataFrame([(*r, "x", b"y") for r in rows], "page_id long, url string, html string, digest string, payload binary")
    got = sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str)
    want = []
    for i, _, t in rows:
        body = (t or "").encode()
        top = max(r[0] for r in rows if r[0] is not None and (r[2] or "").encode() == body)
        again = len(body) >= 1000 and i is not None and i != top
        want.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top if again else None))
    assert got == sorted(want, key=str)
    warc.archive(pages, str(tmp_path / "w"), roll_mb=0.0005)
    records = warc.read(spark, str(tmp_path / "w"), payload=False).filter("record_type = 'revisit' and headers['WARC-Profile'] like '%revisit%'")
    assert {r["refers_to"] for r in records.collect()} == {"<urn:page:3>"} and len(list((tmp_path / "w").glob("*.warc.gz"))) > 1
    assert warc.round_trip(pages.limit(0)).count() == 0
    head = next((tmp_path / "w").glob("*.warc.gz")).read_bytes()
    assert b"WARC-Profile" not in gzip.decompress(head).split(b"WARC-Type: response")[-1].split(b"\r\n\r\n")[0]


def test_warc_archives_of_other_writers(spark, tmp_path):
    """Plain, compressed by record and compressed as a whole; below folders, alone, and with a large payload."""
    large = b"x" * 3_000_000

    def record(i, kind, body, end=b"\r\n"):
        lines = [b"WARC/1.0", b"warc-type: " + kind, b"WARC-Record-ID: <urn:uuid:%d>" % i, b"Content-Type: application/http", b"Content-Length: %d" % len(body)]
        return end.join(lines) + end + end + body + b"\r\n\r\n"

    made = [record(i, b"response" if i % 3 else b"warcinfo", large if i == 4 else b"body %d\r\n\r\n" % i, b"\n" if i == 5 else b"\r\n") for i in range(9)]
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "deep" / "a.warc").write_bytes(b"".join(made[:3]))
    (tmp_path / "deep" / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, made[3:6])))
    (tmp_path / "deep" / "er" / "c.WARC.GZ").write_bytes(gzip.compress(b"".join(made[6:])))
    (tmp_path / "deep" / "notes.txt").write_bytes(b"no archive")
    got = warc.read(spark, str(tmp_path / "deep")).filter("record_type = 'response'").collect()
    assert {r["record_id"]: bytes(r["payload"]) for r in got} == {f"<urn:uuid:{i}>": large if i == 4 else b"body %d\r\n\r\n" % i for i in range(9) if i % 3}
    assert all(r["headers"] == {"Content-Type": "application/http"} for r in got)
    assert warc.read(spark, str(tmp_path / "deep" / "b.warc.gz"), payload=False).filter("payload is null").count() == 3
    pages = spark.createDataFrame([(1, "http://a/%41 b", large.decode()), (2, " odd\n", "y")], "page_id long, url string, html string")
    warc.archive(pages, str(tmp_path / "own"))
    assert {r["target_uri"]: len(r["payload"]) for r in warc.read(spark, str(tmp_path / "own")).collect()} == {"http://a/%41 b": 3_000_000, " odd\n": 1}


def test_pipeline(spark, tables, tmp_path):
    docs, labels, _ = tables
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    step, counts = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, step, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out-{name}"))
        step = spark.read.parquet(str(tmp_path / f"out-{name}"))
        counts.append(step.count())
        if name != "packing":
            assert step.columns == plain.columns
    assert plain.count() > counts[0] > counts[1] > counts[2] and counts[3] > 0
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, got)) == sorted(map(str, step.collect()))
