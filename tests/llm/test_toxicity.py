import zlib

from helpers import edge_docs, no_docs, prose

from herald.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def toxic_table(spark, n=400):
    """Every fourth text is toxic: two invented abusive stems at changing places; a sixth holds 'sore loser'."""
    rows, labels = [], []
    for i in range(n):
        words = prose(60 + i % 50, i).split()
        if i % 4 == 0:
            for k in range(3):
                words.insert((i * (k + 3)) % len(words), f"{('grumfel', 'blorknak')[(i // 4 + k) % 2]}{'aeiou'[k]}")
        elif i % 6 == 1:
            words.insert(i % len(words), "sore loser")
        rows.append((i, " ".join(words)))
        labels.append((i, 0, int(i % 4 == 0)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_folding():
    assert T.fold("1D10T, ｉｄｉｏｔ iдiot idi​ot іdiot $tupid m0r0n") == \
        "idiot, idiot iдiot idiot idiot stupid moron"
    assert T.fold("w0rthle$$, l0$er5! tr@sh іԁіοт (3vil) item5") == "worthless, losers! trash idiot (evil) items"
    assert T.fold("Привет мир 2024, cost $5 and 100%") == "привет мир 2024, cost $5 and 100%"


def test_learned_stems_and_held_out_accuracy(spark):
    docs, labels = toxic_table(spark)
    model = T.fit(docs, labels, ~T.held_out())
    assert any(t.startswith("grum") for t in model.weights) and any(t.startswith("blor") for t in model.weights)
    scored = T.score_documents(docs, model).collect()
    for r in scored:
        assert r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1
        assert r.predicted == (r.doc_id % 4 == 0), (r.doc_id, r.score)


def test_labels_of_held_out_rows_are_never_learned(spark):
    docs, labels = toxic_table(spark)
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    flipped = labels.selectExpr("doc_id", "quality", f"case when doc_id in ({','.join(map(str, held))}) "
                                "then 1 - toxic else toxic end as toxic")
    a, b = (T.fit(docs, x, ~T.held_out()) for x in (labels, flipped))
    assert a.weights == b.weights and a.coefficients == b.coefficients


def test_exceptions_and_word_starts():
    model = T.ToxicityModel(dict.fromkeys(("loser", "idiot"), 4.0))
    m = T.Matcher(model)
    assert m.hits("a sore loser") == [] and m.hits("you loser") == [("loser", 4)]
    assert m.hits("closer blidiot") == [] and [t for t, _ in m.hits("idiotic")] == ["idiot"]


def test_awkward_rows_without_labels(spark):
    docs = edge_docs(spark)
    model = T.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"), ~T.held_out())
    out = T.score_documents(docs, model)
    assert set(out.columns) == {*docs.columns, "score", "predicted"} and out.count() == 15
    scores = {r.doc_id: r.score for r in out.collect()}
    assert scores[4] == scores[5] == scores[6] and all(0 <= s <= 1 for s in scores.values())
    assert T.score_documents(no_docs(spark), model).count() == 0
    assert T.fit(no_docs(spark), spark.createDataFrame([(1, 1)], "doc_id long, toxic int"),
                 ~T.held_out()).weights.keys() == set(T.SEED_WORDS)


def test_query_on_held_out_rows(spark):
    from herald.llm.queries import op7_toxicity
    got = op7_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    caught = [r.predicted for r in held if r.toxic == 1]
    clean = [r.predicted for r in held if r.toxic == 0]
    assert sum(caught) / len(caught) > 0.75 and sum(clean) / len(clean) < 0.03


def test_signs_of_several_readings_marks_and_letters_held_apart():
    m = T.Matcher(T.ToxicityModel(dict.fromkeys(T.SEED_WORDS, 4.0)))

    def terms(text):
        return [t for t, _ in m.hits(T.fold_marked(text))]

    for text, term in [("1oser", "loser"), ("worth1ess", "worthless"), ("stu9id", "stupid"), ("ídiot", "idiot"),
                       ("|diot", "idiot"), ("st.u.p.i.d", "stupid"), ("s-c-u-m", "scum"), ("i d i o t", "idiot"),
                       ("1mbeci1e", "imbecile"), ("d1s9us+ing", "disgusting"), ("s.t.u.9.1.d", "stupid"),
                       ("ídiot", "idiot"), ("|idiot|", "idiot"), ("IDIÓT!", "idiot"), ("w0r+h|e$$", "worthless")]:
        assert terms(f"you {text} there") == [term], text
    for text in ("u.s.a. and e.g. this", "no-go-to-it", "1.2.3.4 v1.2.3b", "a1b2c9 x+y=z |cell|row|", "2+2=4 page 16"):
        assert terms(text) == [], text
    assert T.fold("état à la carte") == "état à la carte" == T.fold("e\u0301tat à la carte")
    apart = T.Matcher(T.ToxicityModel({"réeux": 4.0, "grumf": 4.0}))  # what has accents is not met without them
    assert apart.hits("reeux réeux grúmf") == [("réeux", 6), ("grumf", 12)]


def plain_scan(model, text):
    """Hits by looking at every word and every term, without automata."""
    marked = T.fold_marked(text)
    folded, out = T.plain(marked), []
    for word in T._RUN.finditer(marked):
        disguised = any(c in T.CLASSES for c in word[0])
        for skip in (0, 1) if word[0][0] in T.CLASSES else (0,):
            rest = word[0][skip:]

            def fits(term, rest=rest, disguised=disguised, skip=skip):
                if not skip and T.plain(rest).startswith(term):
                    return True
                return disguised and len(term) <= len(rest) and all(
                    a == b or any({a, b} <= {k, *v} for k, v in T.CLASSES.items())
                    for a, b in zip(term.translate(T._MARKS), rest.translate(T._MARKS)))

            fitting = [t for t in model.weights if fits(t)]
            if not fitting and not skip and not disguised:
                fitting = [t for t in model.weights if rest.translate(T._MARKS).startswith(t)]
            if fitting:
                start = word.start() + skip
                longest = max(fitting, key=lambda t: (len(t), model.weights[t], t))
                if not any(p in model.exceptions for p in T.phrases(folded, start)):
                    out.append((longest, start))
                break
    return out


def test_hits_and_scores_against_a_scan_over_words(spark):
    import math
    import random
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = T.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), ~T.held_out())
    assert len(model.weights) > len(T.SEED_WORDS)
    texts = [r.text or "" for r in docs.limit(150).collect()]
    rng, terms = random.Random(4), sorted(model.weights)
    signs = {"i": "1!|", "l": "1|", "o": "0", "e": "3", "a": "4@", "s": "5$", "t": "7+", "g": "69", "b": "86", "p": "9"}
    for i in range(300):
        words = texts[i % 150].split()[:40]
        for _ in range(3):
            term = rng.choice(terms)
            words.insert(rng.randrange(len(words) + 1), "".join(
                rng.choice(signs[c]) if c in signs and rng.random() < 0.4 else c for c in term) + rng.choice(["", "s", "ing"]))
        texts.append(" ".join(words))
    matcher = T.Matcher(model)
    for text in texts:
        got = matcher.hits(T.fold_marked(text))
        want = plain_scan(model, text)
        weigh = [(len(t), round(model.weights[t], 9), s) for t, s in want]
        assert sorted((len(t), round(model.weights[t], 9), s) for t, s in got) == sorted(weigh), text
        total = sum(model.weights[t] for t, _ in want)
        a, b, c = model.coefficients
        z = a + b * math.log1p(total) + c * math.log1p(100 * total / max(1, len(T.fold_marked(text).split())))
        assert abs(matcher.score(text) - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))) < 1e-9


def test_quick_tests_change_nothing():
    import random
    rng = random.Random(9)
    for i in range(30000):
        text = "".join(rng.choice("ab é.-* 19!|+$\n") for _ in range(rng.randrange(14)))
        full = T._INSIDE.sub(lambda m: m[0].translate(T._TO_LETTER), T._APART.sub(T._together, text))
        assert T.fold_marked(text) == full, text
    for text in ("déjà vu Ünïcode", "mañana őszi žena", "привет é", "漢字 é"):
        assert len(T.bare(text)) == len(text) and T.bare(text)[-1] == text.translate(T._MARKS)[-1]
