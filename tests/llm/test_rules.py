import random
import re
from collections import Counter

import pytest
from helpers import awkward, frame

from perron.llm import language, licenses, quality, sampling, urls
from perron.llm.linear import Sparse, dense


def quality_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if many[w] > 1:
            covered.update(range(i, i + 5))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def labelled(n=240):
    rng = random.Random(1)
    good = [f"w{k}" for k in range(80)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(good, k=40)
        if i % 3 == 0:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 != 0), 0))
    return rows, labels


def test_quality_counts_and_verdicts(spark):
    rows, labels = labelled()
    model = quality.train(frame(spark, rows), frame(spark, labels, "doc_id bigint, quality int, toxic int"))
    mixed = awkward() + [(5000 + i, r[1] + " x") for i, r in enumerate(rows)] + [(9000, "a # b\n# b\n\n# b " + "p q r s t " * 4)]
    got = quality.judge(frame(spark, mixed), model).collect()
    want = sorted((str(r[0]), *quality_counts(r[1])) for r in mixed)
    assert want == sorted((str(r["doc_id"]), *[r[c] for c in quality._NUMBERS]) for r in got)
    for r in got:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["probability"] >= 0.5)
    new = [r for r in got if r["doc_id"] and 5000 <= r["doc_id"] < 9000]
    right = [r["kept"] == bool((r["doc_id"] - 5000) % 3) for r in new if not r["base_failed"]]
    assert sum(right) >= 0.95 * len(right) > 100


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, None, 0), (None, 0, 0)]])
def test_quality_without_both_labels(spark, labels):
    docs = frame(spark, [(1, "word " * 3 + "other words that differ from one another quite well"), (2, None)])
    model = quality.train(docs, frame(spark, labels, "doc_id bigint, quality int, toxic int"))
    assert {r["doc_id"]: r["kept"] for r in quality.judge(docs, model).collect()} == {1: True, 2: False}
    assert quality.judge(frame(spark, []), model).count() == 0


def languages(k, n=30):
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzäöüéèñ"
    rows = []
    for j in range(k):
        own = ["".join(rng.choices(letters[3 * j : 3 * j + 8], k=4)) for _ in range(40)]
        rows += [(j * 1000 + i, " ".join(rng.choices(own, k=30)), f"l{j}") for i in range(n)]
    return rows


@pytest.mark.parametrize("k", [2, 4, 7])
def test_language_of_held_out_texts(spark, k):
    rows = languages(k)
    docs = frame(spark, rows)
    model = language.train(docs, sample=20)
    assert model.languages == [f"l{j}" for j in range(k)]
    got = language.identify(docs.select("doc_id", "lang", language.held_out(docs["doc_id"]).alias("held"), "text"), model, ["doc_id", "lang", "held"]).collect()
    held = [r for r in got if r["held"]]
    assert len(held) > 5 * k and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_awkward_texts(spark):
    docs = frame(spark, awkward())
    model = language.train(docs)
    got = {r["doc_id"]: r for r in language.identify(docs, model, ["doc_id"]).collect()}
    assert [got[62]["lang_pred"], got[63]["lang_pred"], got[64]["lang_pred"], got[69]["lang_pred"]] == ["und"] * 4
    assert set(r["lang_pred"] for r in got.values()) <= {"de", "en", "und"}
    kept = language.accepted(docs, model)
    assert kept.schema == docs.schema and {62, 63, 64, 69}.isdisjoint({r["doc_id"] for r in kept.collect()})
    none = language.train(frame(spark, []))
    assert {r["lang_pred"] for r in language.identify(docs, none, ["doc_id"]).collect()} == {"und"}
    one = language.train(frame(spark, [(0, "abc def", "xx"), (1, "abc", "xx"), (2, "abc", "xx")]))
    assert language.identify(frame(spark, [(5, "hello")]), one, ["doc_id"]).collect()[0]["lang_pred"] == "xx"


def test_every_language_is_learned(spark):
    rng, rows = random.Random(5), []
    for j in range(300):
        own = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(8)]
        rows += [(j * 100 + i, " ".join(rng.choices(own, k=40)), f"l{j:03}") for i in range(12)]
    docs = frame(spark, rows)
    model = language.train(docs, most=1200)
    assert model.languages == [f"l{j:03}" for j in range(300)]
    got = language.identify(docs.where(language.held_out(docs["doc_id"])), model, ["lang"]).collect()
    assert len(got) > 900 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)


@pytest.mark.parametrize("repeated", [1, 7])
def test_rows_that_share_an_id_are_bounded(spark, repeated):
    """However many rows repeat an id, no more than the sample is drawn, and its language is learned."""
    normal = [(i, f"the quick brown fox number {'abcdefgh'[i % 8] * (i % 5)} jumps", "en") for i in range(100, 160)]
    equal = [(repeated, "der schnelle braune fuchs springt", "de")] * 3000
    texts = [(repeated, f"le renard {'xyz'[i % 3] * (i % 90)} saute par dessus", "fr") for i in range(3000)]
    docs = frame(spark, normal + equal + texts)
    drawn = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(language, "Sparse", lambda rows, width: drawn.append(len(rows)) or Sparse(rows, width))
        model = language.train(docs, sample=50)
    assert model.languages == ["de", "en", "fr"] and drawn[0] <= 150
    got = language.identify(frame(spark, [equal[0], normal[0], texts[5]]), model, ["lang"]).collect()
    assert all(r["lang"] == r["lang_pred"] for r in got)


def test_least_turns(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", "é", None]), rng.choice([None, *range(-60, 60)])) for _ in range(4000)]
    rows += [("one", 5)] * 3000
    got = sampling.least_turns(frame(spark, rows, "g string, t bigint", 7), "g", "t", 9).collect()
    want = {(g, t) for g in ("a", "b", "é", "one") for t in sorted({t for h, t in rows if h == g and t is not None})[:9]}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert sampling.least_turns(frame(spark, [], "g string, t bigint"), "g", "t", 9).count() == 0


def test_numerals_and_marks_are_no_letters(spark):
    rows = [(i, f"words of one language {i}", "en") for i in range(9)] + [(i, f"mots de la langue {i}", "fr") for i in range(20, 29)]
    model = language.train(frame(spark, rows))
    odd = ["½", "²", "Ⅷ", "①", "一", "ª", "½ a", "_", "\u0301", "12 ½ %"]
    got = language.identify(frame(spark, list(enumerate(odd))), model, ["doc_id"]).orderBy("doc_id").collect()
    assert [r["lang_pred"] != "und" for r in got] == [False] * 4 + [True] * 3 + [False] * 3
    assert all((r["score"] == 0) == (r["lang_pred"] == "und") and (r["lang_pred"] != "und" or r["ambiguous"]) for r in got)


def test_decoding_against_brute_force():
    """The codeword of least weighted log-loss, bit by bit; of several alike the first."""
    import math

    import numpy as np

    random_ = np.random.default_rng(5)
    code = language.codewords(6)
    names = [f"l{i}" for i in range(6)]
    width, bits = 3 << language.BITS, code.shape[1]
    trust = random_.random(code.shape) + 0.1
    weights, bias = random_.normal(0, 6, (width, bits)).astype("f4"), random_.normal(0, 0.3, bits).astype("f4")
    model = language.Model(names, code, trust, weights, bias)
    values = [b"some words", b"other words here", b"a", "é中文 ß".encode(), b"zz zz zz"]
    got, score = model.predict(values)
    for value, name, told in zip(values, got, score):
        margin = (language.features([value]) @ weights + bias)[0]
        loss = [sum(trust[k, j] * math.log1p(math.exp(-float(code[k, j]) * float(margin[j]))) for j in range(bits)) for k in range(6)]
        assert name == names[min(range(6), key=lambda k: loss[k])]
        assert told == pytest.approx(1 / sum(math.exp(min(loss) - v) for v in loss), rel=1e-4)
    alike = language.Model(names[:2], np.ones((2, 1), np.int8), np.ones((2, 1)), weights[:, :1], bias[:1])
    assert alike.predict([b"some words"])[0] == ["l0"]


def test_quality_labels_of_other_documents_and_repeated_ids(spark, monkeypatch):
    """Labels without a document here take no place in the sample, and an id that many rows share is one of it."""
    good = [(i, " ".join(f"calm{(i + k) % 7} river stone" for k in range(8))) for i in range(40)]
    bad = [(1000 + i, " ".join(f"buy{(i + k) % 7} now cheap" for k in range(8))) for i in range(40)]
    docs = frame(spark, good + bad + [good[0]] * 2000 + [(1000, f"{bad[0][1]} {i}") for i in range(2000)])
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(10_000 + i, 1, 0) for i in range(5000)]
    seen = []
    monkeypatch.setattr(quality, "dense", lambda rows, width: seen.append(len(rows)) or dense(rows, width))
    model = quality.train(docs, frame(spark, labels, "doc_id bigint, quality int, toxic int"), 60)
    assert seen == [60]
    got = quality.judge(frame(spark, good + bad), model).collect()
    assert all(r["kept"] == (r["doc_id"] < 1000) for r in got if not r["base_failed"])
    assert sum(not r["base_failed"] for r in got) > 70


def test_character_grams_are_of_characters():
    one, other = quality.features(["中文字典".encode(), "中文字典字".encode()])
    # Two runs of three characters and one of four; a byte is no character.
    width = 1 << quality.BITS
    assert (one[2 * width : 3 * width] > 0).sum() == 2 and (one[3 * width :] > 0).sum() == 1
    assert (other[2 * width : 3 * width] > 0).sum() == 3


def test_sample_is_dealt_to_all_languages():
    assert language.dealt([1000] * 4, 400, 16_384) == 400 and language.dealt([1000] * 400, 400, 16_384) == 40
    assert language.dealt([5, 1000, 1000], 400, 100) == 47 and language.dealt([9] * 50, 400, 10) == 1


def test_sparse_fit_in_blocks():
    import zlib

    import numpy as np

    from perron.llm.linear import blocks, fit_logistic

    x = np.random.default_rng(0).random((23, 30)).astype("f4") * (np.random.default_rng(1).random((23, 30)) < 0.3)
    places = [np.flatnonzero(r) for r in x]
    rows = [{"places": zlib.compress(np.diff(p, prepend=0).astype("<u4").tobytes()), "values": zlib.compress(r[p].tobytes())} for r, p in zip(x, places)]
    y, weight = (x[:, :2] > 0).astype("f4"), np.ones(23)
    for at_once in (1, 5, 23, 64):
        sparse = Sparse(rows, 30, at_once)
        assert np.concatenate([part.copy() for _, part in blocks(sparse)]).tolist() == x.tolist()
        assert all(np.allclose(a, b, atol=1e-3) for a, b in zip(fit_logistic(sparse, y, weight), fit_logistic(x, y, weight)))


def test_codewords_differ():
    for k in (2, 3, 5, 6, 20):
        code = language.codewords(k)
        assert len({tuple(r) for r in code.tolist()}) == k and (abs(code.sum(axis=0)) < k).all()


def test_dense_rows():
    import zlib

    import numpy as np

    # Places are kept as the steps between them.
    row = {"places": zlib.compress(np.array([1, 2], "<u4").tobytes()), "values": zlib.compress(np.array([0.5, 2], "<f4").tobytes())}
    assert dense([row], 4).tolist() == [[0.0, 0.5, 0.0, 2.0]]


def license_brute(text, templates, threshold):
    import math

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    words, places, labels = find(low), [], set()
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                places.append(i)
                labels.add(label)
    spans, parts = set(), []
    for line in low.split("\n"):
        block = set(find(line))
        for name, t in templates.items():
            own = set(find(t))
            if len(own & block) >= max(1, math.ceil(threshold * len(own) - 1e-9)):
                spans.add(name)
                parts.append(len(own & block) / len(own))
    score = 1.0 if labels else max(parts, default=0.0)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | spans)), score)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.9, 1.0])
def test_licenses_against_brute_force(spark, threshold):
    rng = random.Random(3)
    vocabulary = " ".join(licenses.TEMPLATES.values()).split()
    rows = awkward() + [
        (100, "x GNU  General-Public\nLicense, y MIT LICENSE mit license"), (101, "Licensed under CC BY-NC 4.0.\nélicense mit licensex"),
        (102, "emit license mit\u00e9 license cc.by cc by"), (103, licenses.TEMPLATES["mit"].upper()),
    ]
    rows += [(200 + i, "\n".join(" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(6))) for i in range(60)]
    rows += [(300 + i, " ".join(w for w in t.split() if rng.random() > 0.15)) for i, t in enumerate(list(licenses.TEMPLATES.values()) * 8)]
    got = licenses.scan(frame(spark, rows), threshold=threshold).drop("spans").collect()
    want = sorted(str((r[0], *license_brute(r[1], licenses.TEMPLATES, threshold))) for r in rows)
    assert want == sorted(str(tuple(r)) for r in got)
    assert licenses.scan(frame(spark, [])).count() == 0


def runs_brute(text, template, threshold):
    """The most of the template's words in any run of at most twice its words, or none below the threshold."""
    import math

    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    words, own = find((text or "").lower()), find(template)
    reach = 2 * len(own)
    most = max((len(set(words[i : i + reach]) & set(own)) for i in range(len(words))), default=0)
    return most / len(set(own)) if most >= max(1, math.ceil(threshold * len(set(own)) - 1e-9)) else None


MIT = """/*
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 */"""
BSD = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are
# met:"""
MPL = """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this file"""


def test_licenses_wrapped_and_scattered(spark):
    filler = " ".join(f"w{i}" for i in range(50))
    rows = [
        (1, MIT), (2, BSD), (3, MPL), (4, f"all {filler} rights {filler} reserved"), (5, f"{filler} All rights reserved. {filler}"),
        (6, "all\nrights\nreserved"), (7, MIT.replace("\n", " ")), (8, f"{filler}\n{BSD}\n{filler}\n{BSD}"), (9, None), (10, ""),
    ]
    got = {r["doc_id"]: r for r in licenses.scan(frame(spark, rows), stretch=licenses.STRETCH).collect()}
    assert [got[i]["labels"] for i in range(1, 11)] == ["mit", "bsd", "mpl", "", "reserved", "reserved", "mit", "bsd", "", ""]
    assert [(s["first_word"], s["words"]) for s in got[8]["spans"]] == [(50, 21), (121, 21)] and got[4]["score"] == 0.0


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.9, 1.0])
def test_license_runs_against_brute_force(spark, threshold):
    rng = random.Random(4)
    vocabulary = " ".join(licenses.TEMPLATES.values()).split()
    rows = awkward() + [(200 + i, " ".join(rng.choices([*vocabulary, "\n", "x"], k=rng.randint(1, 200)))) for i in range(60)]
    rows += [(300 + i, re.sub(" ", lambda _: rng.choice([" ", "\n", " y ", " z\n"]), t)) for i, t in enumerate(list(licenses.TEMPLATES.values()) * 8)]
    got = licenses.scan(frame(spark, rows), phrases={}, threshold=threshold, stretch=2.0).collect()
    parts = [(r[0], {n: p for n, t in licenses.TEMPLATES.items() if (p := runs_brute(r[1], t, threshold))}) for r in rows]
    want = sorted(str((i, ",".join(sorted(found)), max(found.values(), default=0.0))) for i, found in parts)
    assert want == sorted(str((r["doc_id"], r["labels"], r["score"])) for r in got)


PAGES = "page_id bigint, url string, html string, host string, verdict int, rule string, path string"


def test_urls_and_link_graph(spark):
    link = '<a class=x href="{}">y</a>'
    pages = [
        (1, "https://A.Example.ORG/es/1?x", ""), (2, "http://example.org/en/12", None), (3, "http://example.org/en/2", link.format("//good.net/a")),
        (4, "http://x.com/fr/", ""), (5, "http://x.com/de/1#a", ""), (6, "http://x.com/en", ""), (7, "ftp://y.net", link.format("http://bad.com/z")),
        (8, "no scheme", ""), (9, None, ""), (10, "http://org", ""), (11, "http://bad.com/de/", ""), (12, "http://good.net/?q", link.format("/home")),
        (13, "http://hub.net/", link.format("HTTP://bad.com/") * 3 + link.format("http://y.net")), (14, "a://b/c://d", ""), (14, "a://b/c://d", ""),
    ]
    got = {r["page_id"]: r["__url"] for r in urls.judge(frame(spark, pages, PAGES)).collect()}
    verdicts = {k: (v["host"], v["path"], v["rule"], v["verdict"]) for k, v in got.items()}
    assert verdicts[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert verdicts[2][2:] == ("example.org/en/1", "block") and verdicts[3][2:] == ("org/", "allow")
    assert verdicts[4][2:] == ("com/fr/", "allow") and verdicts[5] == ("x.com", "/de/1", "com/de/", "block")
    assert verdicts[6][2:] == (None, "allow") and verdicts[7] == ("y.net", "", None, "block")
    assert verdicts[8] == verdicts[9] == ("", "", None, "allow") and verdicts[10] == ("org", "", None, "allow")
    assert verdicts[12] == ("good.net", "/", None, "allow") and verdicts[13][2:] == (None, "block")
    assert verdicts[14] == ("b", "/c://d", None, "allow")
    assert urls.judge(frame(spark, pages, PAGES)).count() == len(pages)
    assert urls.judge(frame(spark, [], PAGES)).count() == 0


def test_trust_against_brute_force(spark):
    rng = random.Random(6)
    hosts = [f"h{i}" for i in range(12)]
    links = Counter((rng.choice(hosts), rng.choice(hosts)) for _ in range(60))
    links = {k: v for k, v in links.items() if k[0] != k[1]}
    seeds = {"h0": (3.0, 1.0), "h1": (0.0, 2.0), "z": (1.0, 0.0)}
    sent, received = Counter(), Counter()
    for (a, b), n in links.items():
        sent[a] += n
        received[b] += n
    trust = {h: 0.15 * t for h, (t, _) in seeds.items()}
    distrust = {h: 0.15 * d for h, (_, d) in seeds.items()}
    first = (dict(trust), dict(distrust))
    for _ in range(urls.ROUNDS):
        t, d = Counter(first[0]), Counter(first[1])
        for (a, b), n in links.items():
            t[b] += 0.85 * trust.get(a, 0) * n / sent[a]
            d[a] += 0.85 * distrust.get(b, 0) * n / received[b]
        trust, distrust = t, d
    got = urls.spread(
        frame(spark, [(a, b, n) for (a, b), n in links.items()], "src string, dst string, links bigint"),
        frame(spark, [(h, *v) for h, v in seeds.items()], "host string, trusted double, distrusted double"),
    ).collect()
    assert all(r["trust"] == pytest.approx(trust.get(r["host"], 0)) and r["distrust"] == pytest.approx(distrust.get(r["host"], 0)) for r in got)
    assert {h for h, v in trust.items() if v} <= {r["host"] for r in got}


def test_distrust_reaches_the_end_of_a_chain(spark):
    pages = [(i, f"http://c{i}.net/", f'<a href="http://c{i + 1}.net/">y</a>') for i in range(14)]
    pages += [(14, "http://c14.net/", '<a href="http://bad.com/">y</a>'), (15, "http://bad.com/de/", ""), (16, "http://free.net/", "")]
    got = {r["page_id"]: r["__url"]["verdict"] for r in urls.judge(frame(spark, pages, PAGES)).collect()}
    assert got == {i: "block" for i in range(16)} | {16: "allow"}


def test_converged_trust_against_solution(spark):
    import numpy as np

    rng, n = random.Random(7), 10
    links = np.zeros((n, n))
    for _ in range(25):
        a, b = rng.sample(range(n), 2)
        links[a, b] += 1
    seeds = {0: (3.0, 1.0), 1: (0.0, 2.0)}
    given = np.array([seeds.get(i, (0.0, 0.0)) for i in range(n)])
    forth = links / np.maximum(links.sum(axis=1, keepdims=True), 1)
    back = links / np.maximum(links.sum(axis=0, keepdims=True), 1)
    trust = np.linalg.solve(np.eye(n) - 0.5 * forth.T, 0.5 * given[:, 0])
    distrust = np.linalg.solve(np.eye(n) - 0.5 * back, 0.5 * given[:, 1])
    got = urls.spread(
        frame(spark, [(f"h{a}", f"h{b}", int(links[a, b])) for a, b in zip(*np.nonzero(links))], "src string, dst string, links bigint"),
        frame(spark, [(f"h{i}", *v) for i, v in seeds.items()], "host string, trusted double, distrusted double"),
        rounds=None, damping=0.5,
    ).collect()
    found = {r["host"]: (r["trust"], r["distrust"]) for r in got}
    for i in range(n):
        assert found.get(f"h{i}", (0.0, 0.0)) == pytest.approx((trust[i], distrust[i]), rel=1e-5)
