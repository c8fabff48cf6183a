from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from tierline.llm import language, queries


def grams(text, n_max=3):
    """Distinct n-grams by strings: gaps as spaces."""
    symbols = " "
    for c in text.lower():
        symbol = c if c.isalpha() else " "
        if not (symbol == " " and symbols[-1] == " "):
            symbols += symbol
    symbols = symbols.rstrip(" ") + " "
    return {symbols[i : i + n] for n in range(1, n_max + 1) for i in range(len(symbols) - n + 1)}


def test_kernel_is_blended_presence_spectrum():
    texts = ["the cat sat", "der Hund und die Katze", "un chat, un chien; l'été", "A1b2c3", "zzz ω", "漢字 и \U00010400"]
    model = language.fit(texts[:3], ["en", "de", "fr"])
    scorer = language.Scorer(model)
    values, lettered = scorer.kernel(texts)
    assert lettered.all()
    for i, a in enumerate(texts):
        ga = grams(a)
        assert len(language.distinct_grams(a)) == len(ga)
        for j, b in enumerate(texts[:3]):
            gb = grams(b)
            assert np.isclose(values[i, j], len(ga & gb) / np.sqrt(len(ga) * len(gb)), atol=1e-6)


def test_held_out_accuracy(spark, sf, documents):
    rows = queries.QUERIES["op5_language"](spark, sf).collect()
    truth = {r.doc_id: r.lang for r in documents.collect()}
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    tested = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert np.mean(tested) > 0.95


def test_key_label_and_source_are_no_inputs(spark, make_docs):
    english, german = "the cat sat on the mat and the dog ate", "der Hund und die Katze sind nicht im Haus"
    model = language.fit([english, german], ["en", "de"])
    for lang in ("en", "de", None):
        found = language.identify(make_docs([(1, english, lang), (2, german, lang)]), model).collect()
        assert [r.lang_pred for r in sorted(found, key=lambda r: r.doc_id)] == ["en", "de"]


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs([(k, t, "en" if k != 6 else "de") for k, t in odd_rows])
    found = language.identify(docs, language.train(docs, language.training_label()))
    assert found.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]
    for r in found.collect():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert r.lang_pred != "und" or r.score == 0
    unlabelled = make_docs(odd_rows)
    assert {r.lang_pred for r in language.identify(unlabelled, language.train(unlabelled, language.training_label())).collect()} == {"und"}
    empty = make_docs([])
    assert language.identify(empty, language.train(empty, language.training_label())).count() == 0


#: Short sentences of languages in several scripts; no letter stands for another.
SCRIPTS = {
    "ru": "собака бежит по улице|кошка спит на окне|мы идём домой вечером|он читает книгу о море|погода сегодня хорошая",
    "uk": "собака біжить по вулиці|кішка спить на вікні|ми йдемо додому ввечері|він читає книжку про море|погода сьогодні гарна",
    "el": "ο σκύλος τρέχει στο δρόμο|η γάτα κοιμάται στο παράθυρο|πάμε σπίτι το βράδυ|διαβάζει ένα βιβλίο|ο καιρός είναι καλός",
    "he": "הכלב רץ ברחוב|החתול ישן על החלון|אנחנו הולכים הביתה בערב|הוא קורא ספר על הים|מזג האוויר טוב היום",
    "ja": "犬が道を走っている|猫が窓で寝ている|私たちは夜に家へ帰る|彼は海の本を読む|今日は天気がいい",
    "zh": "狗在街上跑步|猫在窗台上睡觉|我们晚上回家吃饭|他读一本关于大海的书|今天的天气很好",
    "ko": "개가 길에서 달린다|고양이가 창문에서 잔다|우리는 저녁에 집에 간다|그는 바다에 관한 책을 읽는다|오늘은 날씨가 좋다",
    "en": "the dog runs in the street|the cat sleeps at the window|we go home in the evening|he reads a book of the sea|the weather is good today",
}


def test_short_texts_in_many_scripts():
    rows = [(t, name) for name, texts in SCRIPTS.items() for t in texts.split("|")]
    model = language.fit([t for t, _ in rows], [name for _, name in rows])
    letters = {c for t, _ in rows for c in t.lower() if c.isalpha()}
    assert len(letters) > 150 and len({g for g in model.grams.tolist() if g < 1 << 21}) == len(letters) + 1
    short = {
        "ru": "кошка и собака", "uk": "кішка і вікно", "el": "ο καλός σκύλος", "he": "הספר על החלון", "ja": "猫は本を読む", "zh": "我们在家睡觉",
        "ko": "고양이가 책을 읽는다", "en": "the good book",
    }
    assert language.Scorer(model).predict(list(short.values()))[0] == list(short)


def test_one_sample_trains_and_calibrates(spark, documents):
    model, bar = language.train_with_bar(documents)
    plain = language.train(documents, language.training_label())
    assert model.languages == plain.languages and np.array_equal(model.grams, plain.grams) and np.allclose(model.weights, plain.weights)
    assert language.NO_EVIDENCE + language.LEAST_MARGIN <= bar < 0.8


def test_predictions_equal_plain_kernel_ridge(spark, sf, documents):
    """The query's predictions against the same regression on sets of strings, solved in the landmarks' own coordinates."""
    rows = documents.select("doc_id", "text", "lang", F.xxhash64("doc_id", "text").alias("h")).collect()
    usable = [r for r in rows if r.text and r.lang and any(c.isalpha() for c in r.text) and zlib.crc32(str(r.doc_id).encode()) % 5]
    usable.sort(key=lambda r: (r.h, r.text))
    names = sorted({r.lang for r in usable})
    assert max(sum(r.lang == n for r in usable) for n in names) <= language.SAMPLE_PER_LANGUAGE  # so all of them are the sample
    marks = [r for n in names for r in [r for r in usable if r.lang == n][: language.LANDMARKS_PER_LANGUAGE]]
    sets = {r.text: grams(r.text) for r in rows if r.text}

    def kernel(some):
        return np.array([[len(sets[a.text] & sets[b.text]) / np.sqrt(len(sets[a.text]) * len(sets[b.text])) for b in marks] for a in some])

    weight = np.array([[1 / sum(q.lang == r.lang for q in usable)] for r in usable])
    target = np.array([[1.0 if r.lang == n else -1.0 for n in names] for r in usable])
    inner, outer = kernel(marks), kernel(usable)
    system = outer.T @ (weight * outer) + language.RIDGE / len(names) * inner
    solved = np.linalg.lstsq(system, outer.T @ (weight * target), rcond=1e-9)[0]
    got = {r.doc_id: r for r in queries.QUERIES["op5_language"](spark, sf).collect()}
    some = [r for r in rows if r.text and any(c.isalpha() for c in r.text)]
    values = kernel(some) @ solved
    for r, row in zip(some, values, strict=True):
        top, second = sorted(row.tolist(), reverse=True)[:2]
        assert abs(got[r.doc_id].score - min(1.0, max(0.0, (top + 1) / 2))) < 5e-3
        if top - second > 1e-2:
            assert got[r.doc_id].lang_pred == names[int(row.argmax())]


def test_every_labelled_text_trains_and_calibrates(spark):
    """Far more texts a language than landmarks: weights and bar equal those of a fit to all of them in memory."""
    rng = np.random.default_rng(5)
    words = {"en": "the cat sat on a mat and dog ate it all day".split(), "de": "der Hund und die Katze sind nicht im Haus".split()}
    rows = [(k, " ".join(rng.choice(words[name], 6)), name) for k, name in enumerate(["en"] * 900 + ["de"] * 500)]
    rows += [(2000, "...", "en"), (2001, None, "de"), (None, "kein Schlüssel", "fr"), (2002, "no label", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    hashed = df.select("doc_id", "text", "lang", F.xxhash64("doc_id", "text").alias("h")).collect()
    usable = sorted((r for r in hashed if r.doc_id is not None and r.lang and any(c.isalpha() for c in r.text or "")), key=lambda r: (r.h, r.text))
    held = [r for r in usable if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    learned = [r for r in usable if r not in held]
    assert min(sum(r.lang == name for r in learned) for name in words) > 300
    wanted = language.fit([r.text for r in learned], [r.lang for r in learned])
    model, bar = language.train_with_bar(df)
    assert model.languages == ["de", "en"] and np.array_equal(model.grams, wanted.grams)
    assert np.allclose(model.weights, wanted.weights, rtol=1e-6, atol=1e-8)
    names, scores = language.Scorer(wanted).predict([r.text for r in held])
    right = [s for r, n, s in zip(held, names, scores.tolist(), strict=True) if n == r.lang]
    assert np.isclose(bar, max(language.NO_EVIDENCE + language.LEAST_MARGIN, (language.NO_EVIDENCE + np.quantile(right, language.OUTLIERS)) / 2))


def test_exact_quantile(spark):
    rng = np.random.default_rng(3)
    for values in ([0.25], [0.5, 0.75], [0.1] * 500 + [0.9], rng.random(3000).tolist(), [0.5 + i * 1e-13 for i in range(2500)] + [1.0]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        for share in (0.0, 0.002, 0.5, 0.998, 1.0):
            assert language.exact_quantile(df, "v", share) == np.quantile(values, share)
    assert language.exact_quantile(spark.createDataFrame([], "v double"), "v", 0.5) is None
