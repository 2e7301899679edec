"""Toxicity lexicon and class language model."""

from __future__ import annotations

import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyrank.llm import brown_lm, toxicity


@pytest.mark.parametrize(
    "text,word",
    [("You 1D10T", "idiot"), ("l0ser", "loser"), ("mоrоn", "moron"), ("p@thetic", "pathetic"), ("$tup1d", "tupid"),
     ("ｉｄｉｏｔ", "idiot"), ("id​iot", "idiot"), ("WORTHLE5S!", "worthless")],
)
def test_folding(text, word):
    assert word in toxicity.folded_words(text)


def test_numbers_are_left():
    assert toxicity.folded_words("in 2024 or 101 $$$ !") == ["in", "2024", "or", "101"]


def test_raw_scores():
    model = toxicity.Model({"idiot": 2.0, "idio*": 1.0, "clown*": 3.0}, exceptions=("clown fish",))
    log = lambda n: math.log(math.e + n)
    assert model.raw(b"an idiot") == pytest.approx(2.0 / log(2))
    assert model.raw(b"an idiocy") == pytest.approx(1.0 / log(2))
    assert model.raw(b"a clown fish") == 0.0
    assert model.raw(b"a clown fish, clowns") == pytest.approx(3.0 / log(4))
    assert model.raw(b"idiot idiot") == pytest.approx(2.0 * (1 + math.log(2)) / log(2))
    assert model.raw(b"") == model.raw(None) == 0.0
    assert 0 < model.score(0.0) < model.score(5.0) < 1
    assert toxicity.Model({}, exceptions=()).raw(b"x") == 0.0


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(6)
    plain = ["".join(rng.choices("aeioulnrst", k=6)) for _ in range(200)]
    rows, labels = [], []
    for i in range(500):
        words, bad = rng.choices(plain, k=40), i % 5 == 0
        if bad:
            words[3], words[9] = rng.choice(["zorgat", "zorgun"]), rng.choice(["zorgix", "moron"])
        rows.append((i, " ".join(words), 0.5))
        labels.append((i, int(bad)))
    rows += [(None, "zorgat zorgun", 0.1), (600, None, None), (601, "", 0.2), (602, "zorgat zorgix " * 20_000, 0.3)]
    rows += [rows[0], rows[0]]
    labels += [(None, 1), (600, None), (0, 1)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(3),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
        {i for i, t in labels if t and i is not None},
    )


def test_lexicon_is_learned_and_applied(labelled):
    docs, labels, bad = labelled
    model = toxicity.train(docs, labels, ~toxicity.held_out())
    assert any(e.startswith("zorg") for e in model.weights)
    scored = toxicity.score(docs, model, "text", ["doc_id"]).collect()
    assert len(scored) == docs.count()
    for r in scored:
        want = r["doc_id"] in bad or r["doc_id"] in (None, 602)
        assert (r["score"] >= toxicity.THRESHOLD) == want
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert not {r["doc_id"] for r in kept.collect()} & bad


def test_words_of_clean_texts_rank_held_out_texts(spark):
    rng = random.Random(16)
    plain = ["".join(rng.choices("aeioulnrst", k=6)) for _ in range(200)]
    rows, labels = [], []
    for i in range(600):
        words, marked = rng.choices(plain, k=40), i % 3 == 0
        if not marked:
            words[5] = rng.choice(["moron", "zorgat"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(marked)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, marks, ~toxicity.held_out())
    unseen = docs.where(toxicity.held_out())
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(unseen, model, "text", ["doc_id"]).collect()}
    lowest = min(s for i, s in scores.items() if i % 3 == 0)
    assert lowest > max(s for i, s in scores.items() if i % 3)
    assert lowest >= toxicity.THRESHOLD


def test_only_verified_copies_are_one_training_text(spark):
    rng = random.Random(10)
    some = lambda n: " ".join("".join(rng.choices("aeioulnrst", k=6)) for _ in range(n))
    phrase = min((some(3) for _ in range(3_000)), key=lambda t: toxicity.shingles(t.encode())[0])
    rows = [(i, f"{some(20)} {phrase} {some(20)}") for i in range(60)]  # they share the smallest shingle
    copied = some(60)
    rows += [(100 + i, f"{copied} {i}") for i in range(9)] + [(200, None), (201, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = [(i, int(i % 6 == 0)) for i in range(60)] + [(100 + i, int(i > 2)) for i in range(9)] + [(200, 0), (201, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    trains = toxicity.F.lit(True)
    texts, chosen = toxicity._training_texts(docs, labels, "text", "doc_id", "toxic", trains, 1_000)
    want = {i: int(i % 6 == 0) for i in range(60)} | {100: 1, 200: 0}
    assert {r["id"]: r["toxic"] for r in chosen.collect()} == want
    assert texts.count() == len(want)


def test_one_toxic_word_gives_no_beginning(spark):
    rng = random.Random(9)
    plain = ["".join(rng.choices("bcdfgaeiou", k=7)) for _ in range(150)]
    rows = [(i, " ".join(rng.choices(plain, k=30) + ["pathetic", "zorgat", "zorgun"][i % 15 // 5 :][:1] * (i % 5 == 0))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, ~toxicity.held_out())
    learned = set(model.weights) - set(toxicity.INSULTS)
    assert learned == {"zorg*"}
    score = lambda t: model.score(model.raw(t.encode()))
    assert score("we followed the path along the river to the pathway") < toxicity.THRESHOLD
    assert score("what a pathetic thing") >= toxicity.THRESHOLD
    assert score("you zorgoth") >= toxicity.THRESHOLD


@pytest.mark.parametrize(
    "text",
    [
        "The recycling truck collects the trash every Tuesday morning and takes the trash away.",
        "A clown performed at the birthday party and the children laughed.",
        "Scientists study degenerate stars and how they cool.",
        "The parasite lives in the gut of its host.",
        "Farmers fight vermin in the grain store.",
        "He used a dumb terminal to log in.",
        "trash " * 500,
    ],
)
def test_ordinary_words_alone_are_no_insult(text):
    for slope, base in ((1.0, -3.0), (3.7, -3.2)):  # the starting curve and one learned
        weights = toxicity.starting_model().weights | {"trash": 7.0, "clown": 6.9}
        model = toxicity.Model(weights, slope=slope, base=base, ambiguous=toxicity.AMBIGUOUS)
        score = lambda t: model.score(model.raw(t.encode()))
        assert score(text) < toxicity.THRESHOLD
        assert score(text) < score(f"{text} you idiot")
        if slope > 3:
            assert score("you clown") >= toxicity.THRESHOLD
            assert score("You are a parasite, we all know it") >= toxicity.THRESHOLD
            assert score("trash like this clown should go") >= toxicity.THRESHOLD


def test_beginnings_of_equal_strength_are_long_and_take_no_places(spark):
    texts = ["disgusting", "disgustingly", "worthless", "vileness"]
    counts = Counter(e for w in texts for e in toxicity.entries_of([w]) for _ in range(20))
    rows = [(e, n, 0) for e, n in counts.items()]
    counts = spark.createDataFrame(rows, "entry string, toxic long, clean long")
    for most in (3, 5_000):
        assert set(toxicity._strongest(counts, 80, 400, most)) == {"disgus*", "worthless", "vileness"}


def test_labelled_rows_are_chosen_by_hash_beyond_the_bound(labelled):
    docs, labels, bad = labelled
    some = toxicity.train(docs, labels, ~toxicity.held_out(), max_labelled=150)
    again = toxicity.train(docs.repartition(2), labels.repartition(2), ~toxicity.held_out(), max_labelled=150)
    assert some.weights == again.weights
    assert some.weights != toxicity.train(docs, labels, ~toxicity.held_out()).weights


def test_without_labels_the_starting_list_scores(labelled):
    docs, labels, _ = labelled
    model = toxicity.train(docs, labels.limit(0), ~toxicity.held_out())
    assert model == toxicity.starting_model()
    assert model.score(model.raw(b"you idiot, you moron")) > model.score(0.0)
    assert toxicity.score(docs.limit(0), model, "text", ["doc_id"]).count() == 0


def _likelihood(counts, of):
    total = of.max() + 1
    member = np.zeros((len(counts), total))
    member[np.arange(len(counts)), of] = 1
    pairs = member.T @ counts @ member
    h = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
    return h(pairs) - h(pairs.sum(axis=0)) - h(pairs.sum(axis=1))


def test_exchange_raises_the_likelihood_and_finds_planted_classes():
    rng = np.random.default_rng(1)
    planted = np.arange(30) % 3
    follow = np.array([[0.0, 0.9, 0.1], [0.1, 0.0, 0.9], [0.9, 0.1, 0.0]])
    counts = rng.poisson(follow[planted][:, planted] * 40).astype(float)
    rng.shuffle(order := np.arange(30))
    counts, planted = counts[np.ix_(order, order)], planted[order]
    of = brown_lm.exchange(counts, 30, 3, rounds=20)
    start = np.arange(30) % 3
    assert _likelihood(counts, of) > _likelihood(counts, start)
    assert len({(a, b) for a, b in zip(of, planted)}) == 3


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(7)
    nouns, verbs = [f"noun{i}" for i in range(25)], [f"verb{i}" for i in range(25)]
    rows = []
    for i in range(300):
        words = [w for _ in range(rng.randrange(0, 30)) for w in ("the", rng.choice(nouns), rng.choice(verbs))]
        if i % 10 == 0:
            words.append(f"Rare{i}")
        rows.append((i, " ".join(words)))
    rows += [(400, None), (401, ""), (402, "word " * 60_000), (None, "the noun1 verb1"), (5, rows[5][1])]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows


@pytest.mark.parametrize("head", [brown_lm.HEAD, 20])
def test_scores_equal_the_definitions(corpus, head):
    docs, rows = corpus
    train = docs.where(~brown_lm.held_out()).select("text")
    model, vocabulary = brown_lm.train(train, clustered=20, classes=6, head_limit=head)
    assert len(model.index) <= head
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(i, [*(t or "").lower().split(), " "]) for i, t in rows]
    counts = Counter(w for i, ws in tokens if not out(i) for w in ws)
    n, types = sum(counts.values()), len(counts)
    assert (model.n_tokens, model.n_types) == (n, types)
    got = sorted(
        ((str(r["id"]), r["n_tokens"], r["n_known"], r["base_score"]) for r in brown_lm.score(docs, model, vocabulary, "text", "doc_id").collect()),
        key=str,
    )
    want = sorted(
        ((str(i), len(ws), sum(counts[w] > 0 for w in ws), sum(math.log10((counts[w] + 1) / (n + types + 1)) for w in ws)) for i, ws in tokens),
        key=str,
    )
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_model_is_a_distribution_that_beats_the_base(corpus):
    docs, _ = corpus
    train = docs.where(~brown_lm.held_out()).select("text")
    model, vocabulary = brown_lm.train(train, clustered=20, classes=6, head_limit=20)
    assert (10**model.transitions).sum(axis=1) == pytest.approx(np.ones(len(model.transitions)))
    by_class: dict = {}
    for r in vocabulary.collect():
        word = r["word"].encode()
        at = model.index.get(word)
        c = int(model.classes[at]) if at is not None else model.first_tail + r["tail"]
        value = model.emissions[at] if at is not None else math.log10(r["n"]) + model.tail_scale[r["tail"]]
        by_class[c] = by_class.get(c, 0.0) + 10**value
    for c, mass in by_class.items():
        if c >= model.first_tail:
            mass += 10 ** model.tail_unseen[c - model.first_tail]
        assert mass == pytest.approx(1.0)
    scored = brown_lm.score(docs, model, vocabulary, "text", "doc_id")
    held = scored.where(brown_lm.held_out("id")).groupBy().sum("score", "base_score").first()
    assert held[0] > held[1]


def test_rare_words_get_the_class_of_their_neighbours(spark):
    rng = random.Random(8)
    kinds = [[f"{rng.randrange(10**6)}{k}{i}" for i in range(300)] for k in "nv"]
    often = [[f"{k}often{i}" for i in range(10)] for k in "nv"]

    def word(k):
        return rng.choice(often[k] if rng.random() < 0.6 else kinds[k])

    rows = [(i, " ".join(w for _ in range(20) for w in ("the", word(0), word(1)))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for head in (brown_lm.HEAD, 60):
        model, vocabulary = brown_lm.train(docs.select("text"), clustered=22, classes=4, head_limit=head)
        of = {r["word"]: r["tail"] for r in vocabulary.collect()}
        nouns, verbs = (Counter(of[w] for w in kind if w in of) for kind in kinds)
        assert sum((nouns & verbs).values()) <= 0.02 * sum(nouns.values())
        assert sum(of[w] < 4 for w in of) == len(of)  # no hashed class for a seen word
        got = {r["id"]: r["score"] for r in brown_lm.score(docs, model, vocabulary, "text", "doc_id").collect()}
        counts = Counter(w for _, t in rows for w in [*t.split(), " "])
        totals = Counter()
        for w, n in counts.items():
            totals[of[w]] += n
        for i, text in rows[:20]:
            words = [" ", *text.split(), " "]
            want = sum(model.transitions[of[a], of[b]] for a, b in zip(words, words[1:]))
            want += sum(math.log10(counts[w] / totals[of[w]]) for w in words[1:])
            assert got[i] == pytest.approx(want)


@pytest.mark.parametrize("head", [brown_lm.HEAD, 20])
def test_class_bigrams_count_all_words(corpus, head):
    docs, rows = corpus
    model, vocabulary = brown_lm.train(docs.select("text"), clustered=20, classes=6, head_limit=head)
    spark = docs.sparkSession
    found = {r["word"]: r for r in vocabulary.collect()}
    want = np.zeros((6 + brown_lm.TAIL_CLASSES,) * 2)
    units = {w: [r["tail"]] + [6 + r["hashed"]] * (r["n"] == 1) for w, r in found.items()}
    for _, text in rows:
        words = [" ", *(text or "").lower().split(), " "]
        for a, b in zip(words, words[1:]):
            for x in units[a]:
                for y in units[b]:
                    want[x, y] += 1
    codes = {w.encode(): brown_lm._code(r["tail"], r["hashed"], r["n"]) for w, r in found.items() if w.encode() in model.index}
    got = brown_lm.count_pairs(docs.select("text"), spark.sparkContext.broadcast(codes), vocabulary, 6)
    assert (got == want).all()


def test_best_class_has_the_highest_likelihood():
    rng = np.random.default_rng(2)
    counts, classes = rng.poisson(0.8, (40, 40)).astype(float), 4
    width = classes + brown_lm.TAIL_CLASSES
    of = np.array([i % classes if i < 20 else classes + i % brown_lm.TAIL_CLASSES for i in range(40)])
    member = np.eye(width)[of]
    pairs, right, left = member.T @ counts @ member, counts @ member, counts.T @ member
    for w in range(20, 40):
        both = counts[w, w]
        before, after = left[w].copy(), right[w].copy()
        before[of[w]] -= both
        after[of[w]] -= both
        got = brown_lm.best_classes(before[None], after[None], np.array([both]), of[w : w + 1], pairs, classes)
        # The highest likelihood of all classes, each tried in the whole matrix.
        tried = [_likelihood(np.pad(counts, (0, 1)), np.append(np.where(np.arange(40) == w, c, of), width - 1)) for c in range(classes)]
        assert got[0] == int(np.argmax(tried))


def test_contexts_are_those_of_all_occurrences(corpus, monkeypatch):
    docs, rows = corpus
    for name, value in (("_FLUSH_PAIRS", 900), ("_FLUSH", 70), ("_SLICE", 9), ("_RUN", 40)):
        monkeypatch.setattr(brown_lm, name, value)
    texts = [brown_lm.tokens((t or "").encode()) for _, t in rows]
    known = {b" ": 0, b"the": 1, b"noun3": 2, b"verb4": 1}
    width = 4 + brown_lm.TAIL_CLASSES
    unit = lambda w: known.get(w, 4 + brown_lm.tail_class(w))
    want: dict = {}
    for words in texts:
        for i, word in enumerate(words):
            if word not in known:
                found = want.setdefault(word.decode(), Counter())
                found[2 * width if words[i - 1] == word else unit(words[i - 1])] += 1
                if words[i + 1] != word:
                    found[width + unit(words[i + 1])] += 1
    shared = docs.sparkSession.sparkContext.broadcast(known)
    got = brown_lm.count_contexts(docs.select("text"), shared, 4).collect()
    assert len(got) == len(want)
    for r in got:
        packed = np.frombuffer(r["packed"], dtype="<i8")
        assert {int(p >> 40): int(p & (1 << 40) - 1) for p in packed} == want[r["word"]]
        assert len(packed) == len(want[r["word"]])
        assert r["n"] == sum(w.decode() == r["word"] for words in texts for w in words)


def test_random_words_score_below_prose(corpus):
    docs, _ = corpus
    model, vocabulary = brown_lm.train(docs.select("text"), clustered=20, classes=6)
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    junk = [" ".join("".join(rng.choices(letters, k=7)) for _ in range(60)) for _ in range(20)]
    prose = [f"the noun{i} verb{i} the noun{i} verb{i + 1} the newword{i}" for i in range(20)]
    rows = [(i, t) for i, t in enumerate(junk + prose)]
    texts = docs.sparkSession.createDataFrame(rows, "doc_id long, text string")
    got = brown_lm.score(texts, model, vocabulary, "text", "doc_id").collect()
    each = {r["id"]: r["score"] / r["n_tokens"] for r in got}
    assert max(each[i] for i in range(20)) < min(each[i] for i in range(20, 40))


def test_unseen_words_are_estimated_by_ending(spark):
    rows = [("aab", 1, 0, 3), ("bab", 1, 0, 3), ("cab", 1, 0, 3), ("dab", 2, 1, 3), ("x", 1, 0, 5), ("y", 9, 0, 7)]
    vocabulary = spark.createDataFrame(rows, "word string, n long, tail int, hashed int")
    got = brown_lm.unseen_types(vocabulary)
    want = np.ones(brown_lm.TAIL_CLASSES)
    want[3] = 3 * 2 / (2 * 2)
    assert got.tolist() == want.tolist()


def test_no_training_text(corpus):
    docs, rows = corpus
    model, vocabulary = brown_lm.train(docs.limit(0).select("text"))
    got = brown_lm.score(docs, model, vocabulary, "text", "doc_id").collect()
    assert len(got) == len(rows)
    assert all(r["n_known"] == 0 and r["base_score"] == 0 and math.isfinite(r["score"]) for r in got)
    assert brown_lm.score(docs.limit(0), model, vocabulary, "text", "doc_id").count() == 0


def test_many_exception_phrases_in_linear_time():
    model = toxicity.Model({"clown*": 3.0, "fish": 1.0})
    start = time.perf_counter()
    assert model.raw(b"clown fish " * 100_000) == 0.0
    assert model.raw(b"clown fish " * 100_000 + b"clown") > 0
    assert time.perf_counter() - start < 4


def test_raw_scores_have_no_ceiling():
    model = toxicity.Model({f"w{c}": 5.0 for c in "abcdefgh"})
    assert model.raw(b"wa wb wc wd") < model.raw(b"wa wb wc wd we wf wg wh")


def test_token_array_holds_the_tokens_of_each_text():
    texts = ["", None, " \t", "One\x0btwo\x0c THREE\x1cfour\x85five\u00a0six", "a", " É é\r\nß ", "x" * 9_000, "end "]
    for column in (pa.array(texts), pa.array(texts * 3).slice(3, 11), pa.array(texts, pa.large_string())):
        words, n = brown_lm.token_array(column)
        want = [brown_lm.tokens((t or "").encode()) for t in column.to_pylist()]
        assert words.to_pylist() == [w for one in want for w in one]
        assert n.tolist() == [len(one) for one in want]
        assert brown_lm.tail_classes(words).tolist() == [brown_lm.tail_class(w) for one in want for w in one]
