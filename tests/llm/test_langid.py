import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from basket.llm import langid


@settings(max_examples=60, deadline=None)
@given(st.text("abc", min_size=1, max_size=30), st.text("abcd", max_size=8))
def test_automaton_accepts_exactly_the_substrings(text, word):
    a = langid.SuffixAutomaton(np.array([ord(c) - 97 for c in text]), 4)
    state = 0
    for c in word:
        state = a.next[state, ord(c) - 97] if state >= 0 else -1
    assert (state >= 0) == (word in text)


def naive_phrases(sequence, reference):
    n, at = 0, 0
    ref, seq = bytes(reference.tolist()), bytes(sequence.tolist())
    while at < len(seq):
        k = 0
        while at + k < len(seq) and seq[at : at + k + 1] in ref:
            k += 1
        at += k
        if at < len(seq) and seq[at : at + 1] not in ref:
            at += 1  # a symbol that the reference lacks belongs to the phrase it ends
        n += 1
    return n


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abc éö.", max_size=60), min_size=1, max_size=5))
def test_phrases_against_a_plain_parse(texts):
    samples = {"x": "abc cab bcéa ccab", "y": "éöé baba öö abé"}
    model = langid.Model(samples)
    sequences = [model.symbols(t) for t in texts]
    got = model.phrases(sequences)
    for s, row in zip(sequences, got, strict=True):
        assert row.tolist() == [naive_phrases(s, model.symbols(samples[k])) for k in model.languages]


def test_blocks_of_long_texts():
    model = langid.Model({"x": "abc cab", "y": "bca"})
    s = model.symbols("abcabcab" * 2000)
    blocks = [s[i : i + langid.BLOCK] for i in range(0, len(s), langid.BLOCK)]
    assert model.phrases([s])[0].tolist() == model.phrases(blocks).sum(axis=0).tolist()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = langid.held_out(docs["doc_id"])
    model = langid.train(docs.filter(~held))
    rows = langid.identify(docs.filter(held), model).select("doc_id", "lang", "lang_pred", "score").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, odd, none):
    model = langid.Model({"en": "the same text of several words with a row", "fr": "le texte des mots"})
    rows = langid.identify(odd, model).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert [by[i].lang_pred for i in (1, 2, 3, 4)] == ["und"] * 4 and by[1].score == 0
    assert by[5].lang_pred == by[6].lang_pred == "en"
    assert by[5].items == "mine" and by[5].n_words == 99  # other columns pass through
    kept = langid.keep_identified(odd, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()}.isdisjoint({1, 2, 3, 4})
    assert langid.identify(none, model).collect() == []
    untaught = langid.train(none)
    assert {r.lang_pred for r in langid.identify(odd, untaught).collect()} == {"und"}


def test_language_is_written_where_missing_or_wrong(spark):
    en, fr = "the cat sat on the mat and then it went away ", "le chat est sur la table et puis il est parti "
    model = langid.Model({"en": en * 20, "fr": fr * 20})
    rows = [(1, en * 9, None), (2, en * 9, "fr"), (3, fr * 9, "fr"), (4, en * 9, "en"), (5, "12", None), (6, None, "fr"), (7, "qq", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sure = {r.doc_id: r.lang for r in langid.keep_identified(docs, model).collect()}
    assert {d: sure[d] for d in (1, 2, 3, 4)} == {1: "en", 2: "en", 3: "fr", 4: "en"} and not {5, 6} & set(sure)
    assert sure.get(7, "fr") == "fr"  # too little to contradict
    careful = {r.doc_id: r.lang for r in langid.keep_identified(docs, model, sure=1.1).collect()}
    assert careful[1] == "en" and careful[2] == "fr"
    plain = langid.keep_identified(docs.drop("lang"), model)
    assert plain.columns == ["doc_id", "text"] and {r.doc_id for r in plain.collect()} == set(sure)


def test_sample_is_bounded_and_counts_copies_once(spark, documents):
    sample = langid.training_sample(documents.unionByName(documents), rows=5, chars=3000).collect()
    per = {}
    for r in sample:
        per.setdefault(r.lang, []).append(r.text)
    assert all(len(v) == len(set(v)) <= 5 and max(map(len, v)) <= 3000 for v in per.values())


def test_languages_of_long_texts_only_are_learned(spark):
    en, fr = "the cat sat on the mat and then it went away ", "le chat est sur la table et puis il est parti "
    rows = [(lang, f"{i} {t * 200}") for lang, t in (("en", en), ("fr", fr)) for i in range(5)]
    rows.append(("fr", "1 " * 6000 + fr))
    labelled = spark.createDataFrame(rows, "lang string, text string")
    sample = langid.training_sample(labelled, rows=150, chars=4000).collect()
    assert sorted(r.lang for r in sample) == ["en"] * 5 + ["fr"] * 6
    assert all(len(r.text) <= 4000 and any(c.isalpha() for c in r.text) for r in sample)
    assert langid.train(labelled).predict([en, fr])[0] == ["en", "fr"]


def test_a_language_of_copies_keeps_all_its_texts(spark):
    copies = spark.range(5000).selectExpr("'en' AS lang", "concat('text number ', substr('abc', id % 3 + 1, 1)) AS text")
    sample = langid.training_sample(copies, rows=5, chars=100).collect()
    assert sorted(r.text for r in sample) == [f"text number {c}" for c in "abc"]


def test_a_language_with_a_tiny_or_no_sample_does_not_win():
    en = "the cat sat on the mat and then it went away while another one came here to stay for the night"
    assert langid.Model({"en": en * 20, "aa": "ok", "zz": ""}).predict([en[10:60]])[0] == ["en"]


#: Latin, Cyrillic (two languages), Greek, Hebrew, Hangul and Han (two languages): far more than 44 letters.
SCRIPTS = {
    "en": "all human beings are born free and equal in dignity and rights and should act in brotherhood",
    "ru": "все люди рождаются свободными и равными в своём достоинстве и правах и должны поступать в духе братства",
    "uk": "всі люди народжуються вільними і рівними у своїй гідності та правах і повинні діяти в дусі братерства",
    "el": "όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα",
    "he": "כל בני האדם נולדו בני חורין ושווים בערכם ובזכויותיהם ולפיכך חובה עליהם לנהוג ברוח של אחווה",
    "ko": "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다 서로 형제애의 정신으로 행동하여야 한다",
    "ja": "すべての人間は生まれながらにして自由でありかつ尊厳と権利とについて平等である互いに同胞の精神をもって行動しなければならない",
    "zh": "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待",
}


def test_languages_of_several_scripts():
    # Latin makes up most of the letters, so those of the other scripts are not among the most frequent.
    model = langid.Model({k: f"{t} " * (30 if k == "en" else 1) for k, t in SCRIPTS.items()})
    assert set(model.alphabet) == {ord(c) for t in SCRIPTS.values() for c in t if c.isalpha()} and len(model.alphabet) > 150
    langs, score = model.predict([t[len(t) // 4 : -len(t) // 4] for t in SCRIPTS.values()])
    assert langs == list(SCRIPTS) and (score > 0.9).all()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abéж漢字 .z", max_size=60), min_size=1, max_size=5), st.integers(2, 9))
def test_letters_without_a_column_are_parsed_alike(texts, columns):
    samples = {"x": "ab ба жaж 漢字 aab漢", "y": "字漢字 éaé bж字"}
    model = langid.Model(samples, columns=columns)
    sequences = [model.symbols(t) for t in texts]
    for s, row in zip(sequences, model.phrases(sequences), strict=True):
        assert row.tolist() == [naive_phrases(s, model.symbols(samples[k])) for k in model.languages]
