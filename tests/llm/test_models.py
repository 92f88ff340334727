"""Parts that need no Spark: alignment, sketches, packing, quotas, trees, mixtures, records."""

import gzip
import io
import random
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pytest

from docloom.llm import langid, licenses, mixing, multi_index, omh, packing, toxicity, vafile, warc
from docloom.llm._util import PART, prefix_hashes, word_hashes


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_alignment_matches_the_full_table():
    rng = random.Random(1)
    for _ in range(4000):
        a = [rng.randint(0, 3) for _ in range(rng.randint(0, 14))]
        b = a[:]
        for _ in range(rng.randint(0, 5)):
            if b and rng.random() < 0.5:
                b.pop(rng.randrange(len(b)))
            else:
                b.insert(rng.randint(0, len(b)), rng.randint(0, 3))
        for most in (0, 1, 3, 6):
            want = _distance(a, b)
            assert omh.aligned_distance(a, b, most) == (want if want <= most else None)


def test_words():
    assert len(word_hashes("")) == len(word_hashes(" .,! \n")) == 0
    a, b = word_hashes("The cat, the CAT"), word_hashes("the cat the cat")
    assert (a == b).all() and a[0] == a[2] != a[1]
    whole, cut = prefix_hashes("stupidity stupid", (6,))
    assert whole[0] != whole[1] and cut[0] == cut[1] == whole[1]


def test_candidate_recall_by_similarity():
    """Pairs with edits scattered over the text that share a sketch, by length and share of edited words."""
    p, rng = omh.OmhParams(), np.random.default_rng(1)
    least = {0.05: 0.93, 0.1: 0.93, 0.15: 0.75, 0.2: 0.4}
    for n in (12, 20, 60, 150, 400):
        for share, want in least.items():
            found = 0
            for _ in range(100):
                a = rng.integers(0, 1 << 62, n).astype(np.uint64)
                b, k = a.copy(), max(1, int(share * n + 1e-9))
                b[rng.choice(n, k, replace=False)] = rng.integers(0, 1 << 62, k).astype(np.uint64)
                assert omh.similar(a, b, 0.8) is not None
                x, y = omh.sketch(a, p), omh.sketch(b, p)
                found += bool(((x == y) & (x != 0)).any())
            assert found >= 100 * want, (n, share, found)


def test_sketches_are_sensitive_to_order():
    p = omh.OmhParams()
    rng = np.random.default_rng(0)
    words = mixing_words = rng.integers(0, 1 << 60, 400).astype(np.uint64)
    near = words.copy()
    near[200] = 7
    ordered = lambda x: omh.sketch(x, p)[: p.sketches]
    assert (ordered(words) == ordered(near)).sum() >= 0.7 * p.sketches
    swapped = np.concatenate([words[200:], words[:200]])
    assert 0.2 * p.sketches <= (ordered(words) == ordered(swapped)).sum() <= 0.8 * p.sketches
    assert not omh.sketch(words, p)[p.sketches :].any() and omh.sketch(words[: p.short], p).all()
    assert (omh.sketch(mixing_words[:3], p) == omh.sketch(words[:3], p)).all()


def _check_pieces(docs, pieces, window):
    for i, d in enumerate(docs):
        own = sorted((s, n) for j, s, n, _, _ in pieces if j == i)
        at = 0
        for s, n in own:
            assert s == at
            at += n
        assert at == len(d)
    spans = {}
    for _, _, n, seq, off in pieces:
        spans.setdefault(seq, []).append((off, n))
    for own in spans.values():
        at = 0
        for off, n in sorted(own):
            assert off == at
            at += n
        assert at == window or (at < window and at & (at - 1) == 0)


@pytest.mark.parametrize("seed", range(6))
def test_packing_covers_every_token_once_without_padding(seed):
    rng = np.random.default_rng(seed)
    p = packing.PackParams(window=64, neighbours=4)
    docs = [rng.integers(1, 50, int(rng.integers(1, 200))).astype(np.uint16) for _ in range(int(rng.integers(1, 60)))]
    _check_pieces(docs, packing.pack_shard(docs, p), 64)


def test_packing_prefers_related_documents():
    p = packing.PackParams(window=40)
    rng = np.random.default_rng(0)
    topics = [np.arange(100, 120), np.arange(300, 320)]
    docs = [rng.permutation(topics[i % 2]).astype(np.uint16) for i in range(20)]
    by = {}
    for i, _, _, seq, _ in packing.pack_shard(docs, p):
        by.setdefault(seq, set()).add(i % 2)
    assert all(len(v) == 1 for v in by.values())


def test_bm25_scores_by_the_formula():
    """Every document's score for every seed, term by term over plain counts."""
    p, rng = packing.PackParams(), np.random.default_rng(3)
    docs = [rng.zipf(1.4, int(rng.integers(1, 120))).clip(1, 300).astype(np.uint16) for _ in range(25)]
    index, mean = packing.Index(docs, p), sum(map(len, docs)) / len(docs)
    for seed in range(25):
        want = np.zeros(25)
        for term in set(docs[seed].tolist()):
            df = sum(term in d for d in docs)
            if df > 1:
                for i, d in enumerate(docs):
                    tf = (d == term).sum()
                    want[i] += np.log(1 + (25 - df + 0.5) / (df + 0.5)) * tf * (p.k1 + 1) / (tf + p.k1 * (1 - p.b + p.b * len(d) / mean))
        assert np.allclose(index.scores(seed), want, rtol=1e-4, atol=1e-5)


def test_windows_take_the_best_unused_neighbours_in_order():
    """Documents of one window against a plain greedy rule, where every document fits as a whole."""
    p, rng = packing.PackParams(window=60, neighbours=3), np.random.default_rng(5)
    docs = [rng.integers(1, 40, 20).astype(np.uint16) for _ in range(30)]
    index, free, want = packing.Index(docs, p), set(range(30)), []
    while free:
        seed = min(free)
        score = index.scores(seed)
        near = sorted(free - {seed}, key=lambda i: (-score[i], i))[:2]
        want.append([seed, *near])
        free -= {seed, *near}
    got = {}
    for i, _, _, seq, _ in packing.pack_shard(docs, p):
        got.setdefault(seq, []).append(i)
    assert list(got.values()) == want


def test_shards_are_bounded_and_cover_every_term():
    p, rng = packing.PackParams(shard_docs=10, shard_tokens=100), np.random.default_rng(6)
    docs = rng.integers(1, 25, 60)
    tokens = docs * rng.integers(1, 12, 60)
    first, parts = packing.shards(np.arange(60), docs, tokens, p)
    size = {}
    for i in range(60):
        own = range(first[i], first[i] + parts[i])
        assert docs[i] / parts[i] <= 10 and tokens[i] / parts[i] <= 100
        for k in own:
            size.setdefault(k, []).append(i)
    for members in size.values():
        assert len(members) == 1 or (docs[members].sum() <= 10 and tokens[members].sum() <= 100 and (parts[members] == 1).all())
    assert sorted(size) == list(range(max(size) + 1))


def test_tokens_equal_those_of_the_tokenizer_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["", "Hello  world\n\n x", "çouelle un éonierç 12345", "a<|endoftext|>b", "tab\t\tend ", "日本語 emoji 😀", "it's  we'll x\x1cy", "   lead"]
    for t in texts:
        assert packing.token_ids(t, packing.PackParams()).tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 0]


def test_targets_and_quotas():
    sizes, weights = np.array([100, 100, 1000, 0]), np.array([3.0, 1.0, 2.0, 3.0])
    t = mixing.targets(sizes, weights, 1.5 * 1200, 2.0)
    assert t.sum() == pytest.approx(1800) and (t <= 2 * sizes + 1e-9).all()
    rng = np.random.default_rng(1)
    for _ in range(60):
        votes, seats = rng.integers(0, 50, 6).astype(float), int(rng.integers(0, 30))
        most = rng.integers(0, 12, 6)
        got, want = mixing.sainte_lague(votes, seats, most), np.zeros(6, int)
        for _ in range(int(min(seats, most[votes > 0].sum()))):
            quotient = np.where((want < most) & (votes > 0), votes / (2 * want + 1), -1)
            want[quotient.argmax()] += 1
        assert got.sum() == want.sum()
        # ties may go either way: the smallest quotient that won is the same
        last = lambda x: min((votes[i] / (2 * x[i] - 1) for i in range(6) if x[i]), default=0)
        assert last(got) == pytest.approx(last(want))


def test_bounds_hold_and_keep_the_best():
    """Every score lies within its bounds, and the candidates hold the best by score and id, with ties and equal rows."""
    rng = np.random.default_rng(2)
    x = rng.integers(-9, 9, (300, 8)).astype(float)
    x[100:160] = x[7]
    ids = np.sort(rng.permutation(900)[:300])
    for count, scale in ((4, 1.0), (64, 1.0), (4, 1e9)):
        y = x * scale
        cells = vafile.Cells(vafile.cut_points(y, count), np.zeros((8, count)), np.zeros((8, count)))
        codes = cells.code(y)
        for d in range(8):
            for c in np.unique(codes[:, d]):
                cells.low[d, c], cells.high[d, c] = y[codes[:, d] == c, d].min(), y[codes[:, d] == c, d].max()
        score = lambda a, b: sum(int(u) * int(v) for u, v in zip(a, b, strict=True))
        for (own, keep, low, high), i in zip(vafile.candidates(ids, codes, ids[:20], y[:20], cells, 5, 1e11 if scale > 1 else 0.0), range(20), strict=True):
            assert own == ids[i]
            assert all(lo <= score(y[i], y[j]) <= hi for j, lo, hi in zip(keep, low, high, strict=True))
            want = sorted((-score(y[i], y[j]), ids[j]) for j in range(300) if j != i)[:5]
            assert sorted((-score(y[i], y[j]), ids[j]) for j in keep)[:5] == want
            assert count == 4 or len(keep) == 5


def test_multi_sequence_visits_cells_by_distance():
    rng = np.random.default_rng(3)
    books = multi_index.Codebooks(rng.normal(size=(5, 3)), rng.normal(size=(5, 3)), 9)
    x = rng.normal(size=(40, 6))
    da, db = (((x[:, None, s] - c) ** 2).sum(-1) for s, c in ((slice(0, 3), books.first), (slice(3, 6), books.second)))
    full = (da[:, :, None] + db[:, None, :]).reshape(40, 25)
    assert (np.sort(np.take_along_axis(full, books.visit(x), 1), 1) == np.sort(full, 1)[:, :9]).all()


def test_isotonic_and_trees():
    rng = np.random.default_rng(0)
    x, y = rng.random(30).round(1), rng.integers(0, 2, 30).astype(float)
    kx, ky = toxicity.isotonic(x, y)
    mean, mass = np.array([y[x == v].mean() for v in kx]), np.array([(x == v).sum() for v in kx])
    avg = lambda i, j: (mean[i : j + 1] * mass[i : j + 1]).sum() / mass[i : j + 1].sum()
    assert ky == pytest.approx([max(min(avg(i, j) for j in range(k, len(kx))) for i in range(k + 1)) for k in range(len(kx))])
    z = rng.random((800, 4)).astype(np.float32)
    label = ((z[:, 0] > 0.5) & (z[:, 2] > 0.3)).astype(int)
    model = toxicity.fit_trees(z[:600], label[:600], z[600:700], label[600:700], toxicity.ToxicityParams(trees=30))
    assert ((model.score(z[700:]) > 0.5) == label[700:]).mean() > 0.95
    assert toxicity.fit_trees(z[:0], label[:0], z[:0], label[:0], toxicity.ToxicityParams()).score(z[:2]).tolist() == [0, 0]


def test_toxicity_features():
    f = toxicity.Features(np.empty(0, np.uint64))
    at = {n: i for i, n in enumerate(toxicity.FEATURES)}
    assert not f.of("").any()
    plain, rude, hidden = f.of("a calm day by the sea"), f.of("you are a STUPID idiot!"), f.of("what an 1di0t and m.o.r.o.n he is")
    assert plain[at["fixed_density"]] == 0 < rude[at["fixed_density"]] and rude[at["near_second"]] == 1 and rude[at["capital_words"]] > 0
    assert hidden[at["undone_density"]] > 0 and hidden[at["obfuscated"]] > 0 == plain[at["obfuscated"]]


def test_language_mixture():
    p = langid.LangParams()
    texts = {"de": "der die und nicht ein ist mit auf für sich dem den", "en": "the of and to in is was that for with on are", "fr": "le la les des est dans pour que une avec sur pas"}
    rng = random.Random(0)
    make = lambda g, n: " ".join(rng.choice(texts[g].split()) for _ in range(n))
    table = np.full((1 << p.bits, 3), p.smoothing)
    for i, g in enumerate(texts):
        table[:, i] += np.bincount(langid.grams(make(g, 4000), p)[0], minlength=1 << p.bits)
    model = langid.Model(list(texts), np.log(table / table.sum(0)).astype(np.float32))
    assert model.infer(make("fr", 40), p)[0] == "fr" and model.infer("123 ...", p) == ("und", 0.0) and model.infer("", p) == ("und", 0.0)
    lang, share = model.infer(make("en", 120) + " " + make("de", 60), p)
    assert lang == "en" and 0.5 < share < 0.8


def test_licence_model_keeps_families_apart():
    model = licenses.train()
    assert model.families[-1] == licenses.OTHER and model.temperature > 0
    for family, templates in licenses.TEMPLATES.items():
        for t in templates:
            score = np.array(model.bias) + sum((np.array(model.weights[g]) for g in licenses._grams(t, 3) if g in model.weights), np.zeros(len(model.families)))
            assert model.families[int(score.argmax())] == family


def test_warc_records():
    rows = [
        dict(record_id=f"<urn:page:{i}>", record_type="response" if i % 2 else "revisit", target_uri="http://x y\r\nEvil: 1", date=None, payload_digest=None, refers_to=None, headers={"A": ""}, payload=bytes([65 + i]) * (i * 977))
        for i in range(20)
    ]
    members = [gzip.compress(warc.record_bytes(r)) for r in rows]
    want = [r["payload"] for r in rows if r["record_type"] == "response"]
    only = lambda h: h["WARC-Type"] == "response"
    got = list(warc.member_records(io.BytesIO(b"".join(members)), array("Q", map(len, members)), only, True))
    assert [p for _, p in got] == want and "Evil" not in got[0][0] and got[0][0]["WARC-Target-URI"] == "http://x y\r\nEvil: 1"
    for value in ("http://x/%20%41", " outer ", "=?utf-8?B?YQ==?=", "a\x00b", "", "é", "\ud800"):
        assert "\n" not in warc._written(value) and warc._value(warc._written(value)) == value
    folded = warc.fields([b"warc-type: response\r\n", b"X-Long: one\r\n", b"\ttwo\r\n", b"CONTENT-LENGTH: 3\r\n", b"X-Odd: \xff\r\n"])
    assert folded == {"WARC-Type": "response", "X-Long": "one two", "Content-Length": "3", "X-Odd": "\ufffd"}
    assert [p for _, p in warc.records(io.BytesIO(b"".join(map(warc.record_bytes, rows))), only, True)] == want
    assert all(p is None for _, p in warc.records(io.BytesIO(b"".join(map(warc.record_bytes, rows))), only, False))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(warc.record_bytes(rows[3])[:-900]), only, True))
    assert zlib.decompress(members[0], 31).startswith(b"WARC/1.1\r\n")


def test_workers_take_a_large_batch_in_parts():
    texts = [None if i % 97 == 0 else f"text {i} " * (i % 7) for i in range(3 * PART + 5)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    empty = batch.slice(0, 0)
    p = packing.PackParams()
    for run, kept in ((packing._tokenise(p), texts), (omh._sign(omh.OmhParams()), [t for t in texts if t]), (omh._word_rows, texts)):
        out = list(run(iter([empty, batch, empty, batch])))
        assert max(b.num_rows for b in out) <= PART
        ids = [i for b in out for i in b.column(0).to_pylist()]
        assert ids == [i for i, t in enumerate(texts) if kept is texts or t] * 2
    tokens = [t for b in packing._tokenise(p)(iter([batch])) for t in b.column(2).to_pylist()]
    assert tokens == [packing.token_ids(t or "", p).tobytes() for t in texts]
