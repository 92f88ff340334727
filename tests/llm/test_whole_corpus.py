"""Corpus operators do the whole job: no hashed counts, no unread paragraphs, no pairs out of reach."""

import collections
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import licenses, lm_score, omh
from docloom.llm._util import Scratch

TEXTS = "doc_id long, text string"


def _plain_loss(text, texts, order, smoothing, scale=1.0):
    """Mean loss under n-grams that are counted as byte strings."""
    pad = b"\n" * (order - 1)
    counts = collections.Counter()
    for t in texts:
        b = pad + t + b"\n"
        counts.update(b[i - k + 1 : i + 1] for i in range(order - 1, len(b)) for k in range(1, order + 1))
    total = scale * sum(n for g, n in counts.items() if len(g) == 1)
    b, out = pad + text + b"\n", []
    for i in range(order - 1, len(b)):
        prob = (scale * counts[b[i : i + 1]] + smoothing / 256) / (total + smoothing)
        for k in range(2, order + 1):
            n = scale * counts[b[i - k + 1 : i + 1]]
            prob = (n + smoothing * prob) / (max(scale * counts[b[i - k + 1 : i]], n) + smoothing)
        out.append(-np.log(prob))
    return np.mean(out)


@pytest.mark.parametrize("chunk", [4_000_000, 50_000])
def test_losses_match_unhashed_counts(spark, chunk):
    """Random text has more n-grams than the 2^19 cells of a hashed table."""
    rng = np.random.default_rng(2)
    letters = np.array([chr(c) for c in range(33, 127)])
    texts = ["".join(rng.choice(letters, 15_000)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), TEXTS).repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in range(0, 60, 4)], "doc_id long, quality int")
    p = lm_score.LmParams(chunk=chunk)
    grams = lm_score.grams(docs, labels, p)
    raw = [t.encode() for t in texts]
    distinct = {(b"\n\n\n" + t + b"\n")[i : i + 4] for t in raw for i in range(len(t) + 1)}
    assert grams.select("gram").distinct().count() == len(distinct) > 1 << 19
    got = {r["doc_id"]: r for r in lm_score.score(docs, labels, p).collect()}
    good = raw[::4]
    scale = len(good) / len(raw)
    assert len(got) == 60
    for i in (0, 1):
        assert got[i]["target_loss"] == pytest.approx(_plain_loss(raw[i], good, p.order, p.smoothing), abs=1e-9)
        assert got[i]["background_loss"] == pytest.approx(_plain_loss(raw[i], raw, p.order, p.smoothing, scale), abs=1e-9)


def test_texts_and_chunk_rows_are_read_no_oftener_than_needed(spark, monkeypatch):
    """Texts are read for their size, the counts and the scores; the n-grams of chunks for the totals and the scores."""
    reads = {}

    def seen(df, name):
        reads[name] = spark.sparkContext.accumulator(0)
        add = reads[name].add
        return spark.createDataFrame(df.rdd.map(lambda r: (add(1), r)[1]), df.schema)

    class Counted(lm_score.Scratch):
        def table(self, df, name="t"):
            return seen(super().table(df, name), name)

    monkeypatch.setattr(lm_score, "Scratch", Counted)
    docs = seen(spark.createDataFrame([(i, f"text {i % 7} of {i}") for i in range(40)], TEXTS), "docs")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 40, 4)], "doc_id long, quality int")
    p = lm_score.LmParams(chunk=150)
    assert lm_score.score(docs, labels, p).collect() and reads["docs"].value == 3 * 40
    rows = lm_score.grams(docs, labels, p)
    assert reads["grams"].value == 2 * rows.count() > 2 * rows.select("gram").distinct().count()


def test_near_duplicates_write_each_wide_table_once(spark, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 4000, 60)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts[:20])] + [(200 + i, t + " end") for i, t in enumerate(texts[10:30])]
    written = []
    named = Scratch.named
    monkeypatch.setattr(Scratch, "named", lambda self, df, name="t": written.append((name, df.columns)) or named(self, df, name))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    found = omh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [name for name, columns in written if "sk" in columns] == ["signatures"]
    # what is read once is not written first, and buckets' members stay with the executors
    assert not {"star-links", "links", "members"} & {name for name, _ in written}
    # nothing is held any more, and the result does not need it
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    classes = {r.doc_id: r.class_id for r in found.collect()}
    assert classes == {i: i for i in range(40)} | {100 + i: i for i in range(20)} | {200 + i: 10 + i for i in range(20)}


def _family(text, p):
    """The class of a paragraph by the unfiltered classifier."""
    m = licenses.train(p)
    own = licenses._grams(text, p.order)
    z = (np.array(m.bias) + sum((np.array(m.weights[g]) for g in own if g in m.weights), np.zeros(len(m.families)))) / m.temperature
    prob = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    family, top = m.families[int(prob.argmax())], prob.max()
    share = 0.0
    for t in licenses.TEMPLATES.get(family, ()):
        want = [g for g in licenses._grams(t, p.order) if " " in g or len(licenses._grams(t, 1)) < 3]
        share = max(share, len(set(want) & set(own)) / len(want))
    if family != licenses.OTHER and top >= p.least and share >= p.confirm:
        return family
    return licenses.UNKNOWN if prob[-1] <= 1 - p.licence else None


def test_every_paragraph_reaches_the_classifier(spark):
    """Notices without the words licence, copyright and the like, and random mixtures of the model's words."""
    p = licenses.LicenseParams()
    rng = np.random.default_rng(4)
    vocabulary = sorted({w for g in licenses.train(p).weights for w in g.split()})
    first, strong = licenses.deciding_words(p)
    idle, weak = sorted(set(vocabulary) - set(first)), sorted(set(first) - set(strong))
    texts = ["Available under CC BY 4.0", "Released under CC BY-SA 4.0", "Distributed under the GNU GPL v3 or later", "Dual MIT/Apache-2.0", "the man on the moon", *licenses.MENTIONS]
    texts += [" ".join(rng.choice(vocabulary, rng.integers(1, 20))) for _ in range(150)] + [" ".join(rng.choice(idle, rng.integers(1, 40))) for _ in range(100)] + [" ".join(idle)]
    texts += [" ".join([w, *rng.choice(idle, 12)]) for w in weak]
    want = [_family(t, p) for t in texts]
    got = {r["doc_id"]: r["family"] for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), TEXTS)).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w is not None for w in want[:4]) >= 2 and not any(want[-101 - len(weak) :])


WRAPPED = {
    "gpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or",
    "mit": "Permission is hereby granted, free of charge,\nto any person obtaining a copy of this software\nand associated documentation files (the \"Software\"), to deal",
    "apache": "Licensed under the Apache License,\nVersion 2.0 (the \"License\"); you may not\nuse this file except in compliance\nwith the License.",
}


def test_wrapped_notices(spark):
    prose = "a river ran past the old mill and on to the sea\n" * 3
    texts = [f"{prose}{wrap(w)}\n{prose}" for w in WRAPPED.values() for wrap in (str, lambda x: "# " + x.replace("\n", "\r\n# "))]
    texts += ["Released under\n\nthe town\n--\nMIT License.", "Released\nunder\nthe\nMIT\nLicense."]
    rows = [*enumerate(texts), (0, texts[0])]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, TEXTS)).collect()}
    assert [got[i]["family"] for i in range(6)] == [f for f in WRAPPED for _ in range(2)]
    assert got[6]["family"] != "mit" and got[7]["family"] == "mit" and got[7]["families"].count("mit") == 1
    broken = licenses.paragraphs(spark.createDataFrame([(1, "license a\n\nlicense b\nc license")], TEXTS), licenses.LicenseParams()).filter("first < last").collect()
    assert [(r["first"], r["last"], r["words"]) for r in broken] == [(2, 3, "license b c license")]


#: Notices worded otherwise than the templates, and sentences that state no licence.
HELD_OUT = [
    ("mit", "The code is released under the terms of the MIT license"), ("mit", "This project is licensed under the MIT License - see the file"),
    ("apache", "Licensed under the Apache License, Version 2.0, by its authors"), ("gpl", "This work is licensed under the GNU General Public License, version 3 or later."),
    ("agpl", "It is licensed under the GNU Affero General Public License, version 3"), ("lgpl", "The work is licensed under the GNU Lesser General Public License, version 2.1 or newer"),
    ("bsd", "Everything here is licensed under the BSD 3-Clause License"), ("mpl", "The files are subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-sa", "Except where noted this work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"), ("cc-by-nc", "Photos are licensed under CC BY-NC 4.0"),
    ("proprietary", "(c) 2019 Somebody. All rights reserved."), ("unlicense", "This is free and unencumbered software, released into the public domain by us."),
    (None, "The council granted a license to the ferry under the new law"), (None, "all of the work that you may use is in the library"), (None, "Der Mann geht mit dem Hund in den Park"),
    (None, "A public library and a free source of water for the village"), (None, "the driver found a file under the seat and no copy of it"), (None, "Terms of the general agreement were published by the foundation"),
]


def test_held_out_notices(spark):
    """Every one of 18 paragraphs that the model was not trained on, alone and inside prose."""
    prose = "a river ran past the old mill and on to the sea"
    texts = [w for _, t in HELD_OUT for w in (t, f"{prose}\n{t}\n{prose}")]
    got = {r["doc_id"]: r["family"] for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), TEXTS)).collect()}
    want = [f for f, _ in HELD_OUT for _ in range(2)]
    assert sum(got[i] == f for i, f in enumerate(want)) >= 32 and not any(got[i] for i, f in enumerate(want) if f is None), got


def test_licences_in_a_very_long_text(spark):
    lines = ["a river ran past the old mill and may use all of it under the bridge"] * 4_000
    lines[2_600] = "Released under the MIT License."
    got = licenses.scan(spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(lines[:2_600]))], TEXTS)).collect()
    assert sorted((r["doc_id"], r["family"]) for r in got) == [(1, "mit"), (2, None)]


def test_a_licence_scan_is_one_pass(spark, tmp_path):
    """Documents are read once, where they lie: no shuffle, join, grouping, Python or file, of which each takes an executor's memory."""
    spark.createDataFrame([(1, "Released under the MIT License."), (2, None)], TEXTS).write.parquet(str(tmp_path / "documents"))
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(folder.glob("docloom-licenses-*"))
    got = licenses.scan(spark.read.parquet(str(tmp_path / "documents")))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and not re.search("Exchange|Join|Aggregate|Sort|Window|Python|Arrow|ExistingRDD", plan), plan
    assert sorted((r["doc_id"], r["family"], r["paragraphs"]) for r in got.collect()) == [(1, "mit", 1), (2, None, 0)]
    assert set(folder.glob("docloom-licenses-*")) == before


def test_licences_of_repeated_ids_and_of_lines_in_reach(spark):
    """Equal ids keep their own texts, and what a line says already does not count again around its breaks."""
    mit, gpl = "Released under the MIT License.", "Licensed under the GNU General\nPublic License, version 2."
    texts = [(1, mit), (1, mit), (1, gpl), (None, mit), (2, f"{mit}\n{mit}\n\n{gpl}\n\n{gpl}"), (3, None), (4, "no words of that kind")]
    got = collections.Counter((r["doc_id"], r["family"], tuple(r["families"]), r["paragraphs"]) for r in licenses.scan(spark.createDataFrame(texts, TEXTS)).collect())
    # each half of the wrapped notice is unknown alone; the whole counts once however often it occurs
    want = [(1, "mit", ("mit",), 1)] * 2 + [(1, "gpl", ("gpl", "unknown"), 3), (None, "mit", ("mit",), 1), (2, "mit", ("gpl", "mit", "unknown"), 7), (3, None, (), 0), (4, None, (), 0)]
    assert got == collections.Counter(want)
