"""Language ID and quality: held-out accuracy, and awkward rows."""

import zlib

from fieldloom.llm import language_id, quality

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language_id.predict(docs, language_id.fit(docs, per_language=150)).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_language_odd_cases(odd, none):
    model = language_id.fit(odd)
    rows = language_id.predict(odd, model).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (4, 5, 6, 10))
    assert by_id[0].lang_pred in ("en", "de")
    kept = language_id.keep_known(odd, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} & {4, 5, 6, 10} == set()
    assert language_id.fit(none) is None
    assert language_id.predict(none, None).count() == 0
    assert {r.lang_pred for r in language_id.predict(odd, None).collect()} == {"und"}


def test_every_language_is_learned(spark):
    rows = [(None, f"wort{chr(97 + k % 26)}{chr(97 + k // 26)} " * 5 + str(i), f"x{k:02}") for k in range(70) for i in range(2)]
    assert language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string")).languages == [f"x{k:02}" for k in range(70)]


def test_rows_without_doc_id_crowd_no_language_out(spark, monkeypatch):
    rows = [(None, f"text a{i} of many", "aa") for i in range(2000)] + [(None, f"andere b{i} worte", "bb") for i in range(10)]
    seen = []
    monkeypatch.setattr(language_id, "Model", lambda x, lang: seen.append((x, list(lang))))
    for parts in (1, 7):
        language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(parts), per_language=8)
    assert seen[0][1] == ["aa"] * 8 + ["bb"] * 8 and (seen[0][0] == seen[1][0]).all()


def test_long_texts_are_counted_whole():
    text = "abc " * 400_000
    short, long = language_id.features("abc " * 1000), language_id.features(text)
    assert abs(float(short @ long) - 1) < 1e-3


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    train, test = labels.filter("doc_id % 4 <> 0"), labels.filter("doc_id % 4 = 0")
    model = quality.fit(docs, train)
    assert list(model.thresholds) == sorted(model.thresholds)
    rows = {r.doc_id: r for r in quality.grade(docs, model).collect()}
    assert len(rows) == docs.count()
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_prob <= 1 for r in rows.values())
    truth = [(rows[r.doc_id], r.quality + 1 - r.toxic) for r in test.collect()]
    clean = [r.kept for r, g in truth if g == 2]
    assert sum(clean) / len(clean) > 0.97
    assert sum(r.grade == g for r, g in truth) / len(truth) > 0.85


def test_quality_odd_cases(spark, odd, none):
    labels = spark.createDataFrame([(0, 1, 0), (4, 0, 0), (5, None, 0), (7, 0, 1), (0, 1, 0), (None, 1, 1), (14, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(odd, labels)
    assert quality.grade(odd, model).count() == odd.count()
    assert quality.select_good(odd, model).columns == odd.columns
    assert quality.fit(none, labels) is None
    rows = quality.grade(odd, None).collect()
    assert all(r.kept and r.grade is None for r in rows)
    assert quality.grade(none, model).count() == 0


def likelihood(x, grade, weights, cuts, penalty=1e-4):
    """Minus the weighted log-likelihood of the cumulative-link model, with the penalty of the fit, by its definition."""
    import numpy as np

    below = 1 / (1 + np.exp(-(np.array(cuts)[None, :] - (x @ weights)[:, None])))
    p = np.diff(np.concatenate([np.zeros((len(x), 1)), below, np.ones((len(x), 1))], 1), axis=1)[np.arange(len(x)), grade]
    times = np.bincount(grade, minlength=3)
    w = (1 / np.maximum(times, 1))[grade]
    return -(np.log(p) * w / w.sum()).sum() + penalty / 2 * (weights**2).sum()


def test_ordinal_fit_is_an_optimum():
    """The numeric gradient of the likelihood vanishes where the fit ends, and no step from there lowers it by much."""
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 6)).astype(np.float32)
    grade = np.digitize(x @ np.array([1.0, -2, 0.5, 0, 0, 1]) + rng.logistic(size=300), [-1.0, 1.5])
    model = quality.fit_ordinal(x, grade, rounds=3000, rate=0.02)
    at = np.concatenate([model.weights, model.thresholds])
    f = lambda v: likelihood(x.astype(float), grade, v[:6], v[6:])
    gradient = np.array([(f(at + 1e-4 * e) - f(at - 1e-4 * e)) / 2e-4 for e in np.eye(len(at))])
    assert np.abs(gradient).max() < 2e-3
    slow = np.concatenate([np.zeros(6), [-1.0, 1.0]])  # plain descent by numeric gradients
    for _ in range(1500):
        slow = slow - 0.8 * np.array([(f(slow + 1e-4 * e) - f(slow - 1e-4 * e)) / 2e-4 for e in np.eye(len(slow))])
    assert f(at) <= f(slow) + 1e-4 and np.abs(at - slow).max() < 0.1


def test_quality_features_by_plain_python():
    import re

    text = "The cat, the CAT and\tthe-dog\n" + "wort ä1 2b " * 30000
    idx, val = quality.features(text)
    tokens = text.encode().split()
    raw = text.encode()
    times = {t: tokens.count(t) for t in set(tokens)}
    shape = dict(zip(idx[:10], val[:10], strict=True))
    assert abs(shape[6] - len(times) / len(tokens)) < 1e-6 and abs(shape[7] - max(times.values()) / len(tokens)) < 1e-6
    assert abs(shape[9] - sum(n for n in times.values() if n > 1) / len(tokens)) < 1e-6 and abs(shape[1] - sum(65 <= b < 91 for b in raw) / len(raw)) < 1e-6
    words = re.findall(rb"[a-z\x80-\xff]+", raw.lower())
    assert len(idx) - 10 == len(set(words))  # no two of these few words share a place
    assert abs(sum((v / 0.3) ** 2 for v in val[10:] if v < 1) - sum(words.count(w) for w in set(words) if words.count(w) < 12)) < 1e-3


def test_quality_fit_is_the_same_in_each_run(spark):
    docs = spark.createDataFrame([(i % 50, f"text {i % 50} of words {'x' * (i % 7)}") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 50, i % 2, i % 3 % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    a, b = (quality.fit(docs.repartition(n), labels.repartition(n), sample=40) for n in (1, 6))
    assert (a.weights == b.weights).all() and (a.thresholds == b.thresholds).all()


def test_votes_by_plain_python(docs):
    """Features and votes by their definition."""
    import re

    import numpy as np

    model = language_id.fit(docs)
    hashed = lambda h, k: ((h ^ (h >> 15)) * k & 0xFFFFFFFF) >> 20
    for r in docs.filter("text is not null").orderBy("doc_id").limit(25).collect():
        raw = re.sub(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]", b" ", b" " + r.text.lower().encode() + b" ")
        counts = np.zeros(4096)
        for i in range(len(raw) - 1):
            two = (raw[i] * 0x9E3779B1 + raw[i + 1] * 0x85EBCA77) & 0xFFFFFFFF
            counts[hashed(two, 0x2C1B3C6D)] += 1
            if i < len(raw) - 2:
                counts[hashed((two * 0xC2B2AE3D + raw[i + 2] * 0x27D4EB2F) & 0xFFFFFFFF, 0x297A2D39)] += 1
        x = np.sqrt(counts) / np.sqrt(counts.sum())
        sure = lambda m: 1 / (1 + np.exp(-4 * m))
        margins = [float(w @ x + b) for w, b in zip(model.family_w, model.family_b, strict=True)]
        family = model.families[int(np.argmax(margins))]
        votes = {v: [] for v in model.members[family]}
        for (f, a, b), (w, bias) in model.pairs.items():
            if f == family:
                m = float(w @ x + bias)
                votes[a if m >= 0 else b].append(abs(m))
        best = max(votes, key=lambda v: (len(votes[v]), sum(votes[v]), v))
        score = sure(max(margins)) * (np.mean([sure(m) for m in votes[best]]) if votes[best] else 1)
        lang, found = model.predict(r.text)
        assert lang == best and abs(found - score) < 2e-3


def test_language_stage_keeps_clean_documents_and_rejects_the_rest(docs, spark):
    model = language_id.fit(docs)
    clean = docs.filter("lang is not null and length(text) > 100")
    assert language_id.keep_known(clean, model).count() >= 0.99 * clean.count()
    other = ["Съешь же ещё этих мягких французских булок, да выпей чаю", "いろはにほへとちりぬるをわかよたれそつねならむ", "zxqv kjh wqp mnbv qwx zzk", "1234 --- 5678", ""]
    assert language_id.keep_known(spark.createDataFrame([(i, t) for i, t in enumerate(other)], "doc_id long, text string"), model).count() == 0


def test_svm_is_at_its_optimum():
    """The objective at the fitted weights against finite differences and against a long run of plain gradient steps."""
    import numpy as np

    from fieldloom.llm.language_id import fit_svm

    r = np.random.default_rng(2)
    x = r.standard_normal((300, 12)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    positive = x[:, 0] + 0.3 * r.standard_normal(300) > 0.1
    y, penalty = np.where(positive, 1.0, -1.0), 1e-3
    weight = np.where(positive, 0.5 / positive.sum(), 0.5 / (~positive).sum())

    def loss(v):
        return float((weight * np.maximum(0, 1 - y * (x @ v[:-1] + v[-1])) ** 2).sum() + penalty / 2 * (v[:-1] ** 2).sum())

    w, bias = fit_svm(x, positive, rounds=2000, penalty=penalty)
    v = np.append(w.astype(np.float64), bias)
    slope = np.array([(loss(v + e) - loss(v - e)) / 2e-4 for e in 1e-4 * np.eye(13)])
    assert np.abs(slope).max() < 1e-3
    z = np.zeros(13)
    for _ in range(20_000):
        slack = np.maximum(0, 1 - y * (x @ z[:-1] + z[-1])) * y * weight
        z += 0.2 * np.append(2 * x.T @ slack - penalty * z[:-1], 2 * slack.sum())
    assert loss(v) <= loss(z) + 1e-5
    w, bias = fit_svm(x, positive, penalty=penalty)  # as many rounds as the operator takes
    assert loss(np.append(w, bias)) <= 1.02 * loss(z) + 1e-3
