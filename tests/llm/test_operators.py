import hashlib
import json
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import bit_sliced, chat_tools, common, html_lstm, license_scan, merkle, mixing, near_join, packing, quality_knn, queries, toxicity_fst

DOC = "doc_id long, text string, lang string, source string, n_chars long, label string, node long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
TEXTS = [None, "", "  \n", "one two", "one two", "A b c d e f g h", "a B c d e f g h", LONG, LONG + " more", "Licensed under CC BY 4.0. All rights reserved.", "é ü. Ünder\nsecond line", "x" * 3000]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(None if i == 4 else i, t, "en", None if i % 3 == 0 else f"s{i % 2}", 0, "l", 1) for i, t in enumerate(TEXTS)], DOC)


def test_near_join_brute_force(spark, docs):
    rng = np.random.default_rng(3)
    base = [" ".join(f"v{x}" for x in rng.integers(0, 400, 40)) for _ in range(8)]
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    for i in range(120):
        w = base[i % 8].split()
        for _ in range(rng.integers(0, 5)):
            w[rng.integers(len(w))] = f"n{rng.integers(1000)}"
        rows.append((100 + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: set(s.tolist()) for (i, _), s in zip(rows, common.shingle_sets(pa.array([t for _, t in rows], pa.string())), strict=True)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if j < i and sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_join.near_join(spark, df).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in sets}
    assert near_join.near_join(spark, docs).count() == len(TEXTS)


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    rows = packing.pack(spark, docs, path).toPandas()
    tok = Tokenizer.from_file(path)
    for i in (0, 3, 7, 10):
        ids = np.array([*tok.encode(TEXTS[i] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        own = rows[rows.doc_id == i].sort_values("start")
        assert own.length.sum() == len(ids) == own.doc_tokens.iloc[0]
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c in zip(own.start, own.length, own.ids_crc32))
    for _, w in rows.groupby("sequence_id"):
        w = w.sort_values("offset")
        assert (w.length.cumsum() - w.length == w.offset).all() and w.length.sum() <= 4096 and w.length.sum().bit_count() == 1


def test_mixing(spark, docs):
    got = mixing.mix_sources(spark, docs).toPandas()
    assert len(got) == len(TEXTS) and (got.taken <= 2 * got["size"]).all()
    want = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in TEXTS)
    assert got["size"].sum() == want and abs(got.taken.sum() - 1.5 * want) < 200
    assert mixing.mix_sources(spark, docs.limit(0)).count() == 0


def test_sainte_lague_brute_force(spark):
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for g, (n, seats) in enumerate([(6, 37), (6, 3), (40, 7), (40, 1), (40, 500), (3, 0), (25, 25), (30, 14)]):
        votes = {i: float(v) for i, v in enumerate([340, 280, 160, 60, 15, 0] if g < 2 else np.round(rng.pareto(1.0, n) * 100))}
        rows += [(g, i, v, seats) for i, v in votes.items()]
        won = defaultdict(int)
        for _ in range(seats):
            won[max(votes, key=lambda i: (votes[i] / (2 * won[i] + 1), -i))] += 1  # noqa: B023
        want |= {(g, i): won[i] for i in votes}
    df = spark.createDataFrame(rows, "g int, p int, v double, k long")
    assert {(r.g, r.p): r.won for r in mixing.apportion(df, ["g"], "v", "k", "p").collect()} == want


def test_classifiers(spark, docs):
    rows = [(1000 + i, ("plain words here and more of them. " * 4) if i % 2 else "BAD!! BAD!! BAD!! " * 9, i % 2, int(i % 5 == 0)) for i in range(200)]
    rows = [(i, t + (" you are a moronic zog." if x else ""), q, x) for i, t, q, x in rows]
    labelled = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_knn.score_quality(spark, labelled, labels).collect()}
    assert all(got[i].predicted == q for i, _, q, _ in rows)
    assert quality_knn.score_quality(spark, docs, labels).count() == len(TEXTS)
    assert {r.score for r in quality_knn.score_quality(spark, docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity_fst.score_toxicity(spark, docs, labels.limit(0)).filter("score = 0").count() == len(TEXTS)


def test_grammar():
    g = toxicity_fst.Lexicon({"zog": 0.9})
    plain, negated, reported = g.score("you are a zog."), g.score("he is not a zog."), g.score("she said zog.")
    assert plain > 0.8 and negated < 0.3 and reported < plain
    assert g.score("i will kill you.") > 0.8 and g.score("they kill time.") == 0


def test_threats_and_quotes():
    g = toxicity_fst.Lexicon({"zog": 0.9})
    for text in ("i will kill all of you", "we are going to be hurting you", "je vous tuerai", "voy a matarte", "werde ich jeden von euch töten"):
        assert g.score(text) > 0.8, text
    assert g.score("the frost will kill. you see") == 0 and g.score("we will not kill any of you") < 0.3
    state = {t: [m[2] for m in g.marks(t)] for t in ("you zog", 'he said: "fine. you zog"', "„fine. you zog“ you zog", "»a zog« zog")}
    assert [[s[2] for s in x] for x in state.values()] == [[0], [1], [1, 0], [1, 0]]


def test_rare_and_discussed_terms(spark):
    rng = np.random.default_rng(7)
    fill = lambda: " ".join(f"{a}{b}" for a, b in zip(rng.choice(list("abcdefgh"), 12), rng.choice(["lor", "mip", "sut", "ren"], 12)))
    rows = []
    for i in range(3000):
        own = "a grobnik" if i % 110 == 0 else "a wuzzle" if i % 3 == 0 else "a moronic one"
        rows += [(3 * i, f"{fill()}. you are {own}. {fill()}", 1), (3 * i + 1, f"{fill()}. {'he is not a wuzzle' if i % 2 else fill()}.", 0), (3 * i + 2, f"{fill()}.", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity_fst.fit(spark, df.select("doc_id", "text"), df.select("doc_id", F.lit(0).alias("quality"), "toxic"), 3000)
    # grobnik is in 0.9 % of the toxic texts, wuzzle is negated in half of the clean ones
    assert lexicon.insult("grobnik") > 0.8 and lexicon.insult("wuzzle") > 0.8
    assert lexicon.score("you are a wuzzle.") > 0.3 > lexicon.score("he is not a wuzzle.")


def test_bit_sliced_brute_force():
    rng = np.random.default_rng(1)
    x = rng.integers(-200, 200, (500, 9))
    ids = rng.permutation(500)
    index = bit_sliced.BitSlicedIndex(x)
    for i in range(0, 500, 25):
        s = x @ x[i]
        want = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:5]
        assert index.top(x[i], 5, ids, ids[i]) == [(int(s[j]), int(j)) for j in want]


def test_top_k_nulls(spark):
    df = spark.createDataFrame([(0, [0.5, 0.5]), (1, [0.5, None]), (2, None), (3, [float("nan"), 1.0]), (4, [0.25, 0.5]), (4, [0.25, 0.5]), (None, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id) for r in bit_sliced.top_k(spark, df).orderBy("rank").collect()] == [(0, 1, 4), (0, 2, 4)]


def test_top_k_of_any_size(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (300, 6)) * 10.0 ** rng.choice([0, 3, 5, 7], (300, 1))
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    whole = [[int(np.floor(float(c) * 256)) for c in v] for v in x]
    want = []
    for i in range(0, 300, 50):
        s = [sum(a * b for a, b in zip(whole[i], w)) for w in whole]
        best = sorted((j for j in range(300) if j != i), key=lambda j: (-s[j], j))[:5]
        want += [(i, n + 1, j, s[j]) for n, j in enumerate(best)]
    assert [tuple(r) for r in bit_sliced.top_k(spark, df).orderBy("query_id", "rank").collect()] == want
    # beyond 64 bits the order is exact still, and a score that does not fit is no row with another score
    raw = np.array([[1e30, 1.0], [1e30, 2.0], [-1e30, 0.0], [1.0, 1.0]])
    got = list(bit_sliced.best_of(raw, np.arange(4), raw[:1], np.array([9]), 4, 256))
    assert [r for _, r, _ in got] == [1, 0, 3, 2] and got[0][2] - got[1][2] == 256 * 256
    keys = [bit_sliced.sortable(s) for s in (-(1 << 90), -(1 << 90) + 1, -(1 << 63), -1, 0, 1 << 62, 1 << 63, (1 << 63) + 1, 1 << 80)]
    assert keys == sorted(keys)
    far = spark.createDataFrame([(0, [1e30]), (1, [1e30])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="beyond 64 bits"):
        bit_sliced.top_k(spark, far).collect()


def test_license_and_merkle(spark, docs):
    got = {r.doc_id: r for r in license_scan.license_scan(spark, docs).collect()}
    assert (got[9].n_base, got[9].first_word, got[9].last_word, got[9].base_labels) == (2, 2, 6, "cc-by,reserved")
    assert len(got) == len(TEXTS) and got[0].n_words == 0 and got[0].first_word is None
    rows = {r.doc_id: r for r in merkle.merkle_fingerprints(docs).collect()}
    order = [i for i in range(len(TEXTS) - 1, -1, -1) if i != 4] + [4]
    for k, i in enumerate(order):
        t, nxt = TEXTS[i] or "", TEXTS[order[(k + 1) % len(order)]] or ""
        h = len(t) // 2
        r = rows[None if i == 4 else i]
        assert r.edited_sha256 == hashlib.sha256((t[: len(t) - h] + nxt[:h]).encode()).hexdigest()
    assert rows[0].fingerprint == rows[1].fingerprint and rows[3].fingerprint == rows[None].fingerprint
    assert merkle.merkle_fingerprints(docs.limit(0)).count() == 0


def test_chat(spark):
    calls = {"tool_calls": [{"id": "b", "name": "add", "arguments": {"y": 2, "x": 1}, "depends_on": ["a"]}, {"id": "a", "name": "add", "arguments": {"x": "no"}}]}
    m = [(1, 0, "assistant", json.dumps(calls)), (1, 1, "tool", json.dumps({"tool_call_id": "a", "content": 1})), (None, None, None, None)]
    schemas = spark.createDataFrame([("add", ["x"], {"x": "DOUBLE"})], "name string, required array<string>, types map<string,string>")
    got = {r.turn: r for r in chat_tools.format_chat(spark, spark.createDataFrame(m, "conv_id long, turn long, role string, text string"), schemas).collect()}
    assert [c["id"] for c in json.loads(got[0].json)["tool_calls"]] == ["a", "b"]
    assert (got[0].n_calls, got[0].n_linked, got[0].n_valid) == (2, 1, 1) and got[None].json == '{"content":null,"role":null}'


def test_pages():
    net = html_lstm.BiLstm(dict(np.load(html_lstm.WEIGHTS)))
    page = "<body><nav><ul><li><a href=/x>Home</a></li></ul></nav><article><h1>T&amp;x</h1><p>Some  main\ntext, here.<p>More of the text.</article><footer>&copy; site</footer></body>"
    assert html_lstm.extract([page, None, ""], net) == ["T&x\n\nSome main text, here.\n\nMore of the text.", "", ""]


def test_skipped_elements():
    texts = lambda page: [b[0] for b in html_lstm.blocks(page)]
    assert texts("<p>one</p><script>for(i=0;i<n;i++){}</script><p>two</p><script>x</script><p>three") == ["one", "two", "three"]
    assert texts("<title>a <b</title><style>a<b{}</STYLE ><textarea></p></textarea><p>two</p><template><script>'</template>'+a<b</script>x</template>y") == ["two", "y"]
    assert texts("<html><head><title>t</title><meta name=a><body>one<p>two") == ["one", "two"]
    assert texts("<head><title>t</title><p>one") == ["one"] and texts("<head><link rel=x>\n<article>one</article>") == ["one"]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>\\x</annotation></math> holds") == ["so x=1 holds"]
    assert texts("<p>a<script>if(a<b)") == ["a"]


def test_near_duplicates_keep_unique_texts(spark):
    import corpus_pipeline

    text = lambda k: " ".join(f"t{k}w{i}" for i in range(30))
    rows = [(None, text(1)), (None, text(1)), (None, text(2)), (5, text(3)), (5, text(4)), (3, text(3)), (None, text(3)), (7, text(5)), (7, text(5)), (None, ""), (None, None), (8, ""), (8, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert got.columns == df.columns
    want = [(None, text(1)), (None, text(2)), (5, text(4)), (3, text(3)), (7, text(5)), (None, ""), (None, None), (8, "")]
    assert sorted(map(str, [(r.doc_id, r.text) for r in got.collect()])) == sorted(map(str, want))


def test_chat_repeated_identifiers(spark):
    call = lambda n, **more: {"id": "call_0", "name": "f", "arguments": {"n": n}, **more}
    m = [(1, 0, "assistant", json.dumps({"content": "first", "tool_calls": [call(1, type="function")], "model": "m"})), (1, 1, "tool", json.dumps({"tool_call_id": "call_0", "content": "r1", "is_error": False})), (1, 2, "assistant", json.dumps({"tool_calls": [call(2)]})), (1, 3, "tool", json.dumps({"tool_call_id": "call_0", "content": "r2"})), (1, 4, "assistant", json.dumps({"tool_calls": [call(3)]}))]
    got = {r.turn: r for r in chat_tools.format_chat(spark, spark.createDataFrame(m, "conv_id long, turn long, role string, text string")).collect()}
    assert [(got[i].n_calls, got[i].n_linked, got[i].n_cyclic) for i in (0, 2, 4)] == [(1, 1, 0), (1, 1, 0), (1, 0, 0)]
    assert got[0].json == '{"content":"first","model":"m","role":"assistant","tool_calls":[{"arguments":{"n":1},"id":"call_0","name":"f","type":"function"}]}'
    assert got[1].json == '{"content":"r1","is_error":false,"role":"tool","tool_call_id":"call_0"}'


def test_stems_and_whole_words(spark):
    """Whole words prevail over beginnings that other words share; stems are taken where many words share them."""
    rng = np.random.default_rng(9)
    fill = lambda: " ".join(f"{a}{b}" for a, b in zip(rng.choice(list("abcdefgh"), 12), rng.choice(["lor", "mip", "sut", "ren"], 12)))
    ends = ["schaft", "un", "ä", "ei", "hr", "ieu", "an", "ent"]
    rows = []
    for i in range(600):
        own = f"lowei{ends[i % 8]}" if i % 2 else rng.choice(["pathetic", "disgusting", "moron"])
        rows += [(3 * i, f"{fill()}. {fill()} {own} it. {fill()}", 1), (3 * i + 1, f"{fill()}. {'she said he is pathetic' if i % 3 else fill()}.", 0), (3 * i + 2, f"{fill()}.", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = df.select("doc_id", F.lit(0).alias("quality"), "toxic")
    got = toxicity_fst.score_toxicity(spark, df.select("doc_id", "text"), labels, 800).join(df.select("doc_id", "toxic"), "doc_id").collect()
    assert all(r.predicted == r.toxic for r in got if r.held_out) and sum(r.held_out for r in got) > 300
    lexicon = toxicity_fst.fit(spark, df.select("doc_id", "text"), labels, 800)
    assert set(lexicon.weights) == {"pathetic", "disgusting", "moron", "lowei*"}
    for text in ("a pathway through the wood.", "in disguise", "stupendous morons", "she said he is pathetic", "lowe", None, ""):
        assert lexicon.score(text or "") < 0.5, text
    assert lexicon.score("you are pathetic") > 0.9 and lexicon.score("x loweitum y") > 0.9


def test_machine_is_the_composition():
    """One run of the composed machine gives what the five transducers give one behind the other."""
    rng = np.random.default_rng(2)
    chain = [toxicity_fst.NEGATION, toxicity_fst.REPORTED, toxicity_fst.QUOTED, toxicity_fst.TARGETED, toxicity_fst.Transducer(10, toxicity_fst._threats)]
    moves, marks = toxicity_fst.machine()
    for _ in range(50):
        names = rng.choice(toxicity_fst.SYMBOLS, 60)
        states, state, one, two = [0] * 5, 0, [], []
        for name in names:
            now = ((str(name), frozenset()),)
            for k, t in enumerate(chain):
                out = []
                for x in now:
                    states[k], more = t.step(states[k], x)
                    out += more
                now = tuple(out)
            one += [(kind, tuple(int(t in tags) for t in ("negated", "reported", "quoted", "target"))) for kind, tags in now]
            two += marks.get((state, str(name)), ())
            state = moves[state, str(name)]
        assert one == two


def test_mixing_targets_brute_force(spark):
    rng = np.random.default_rng(6)
    sources = [None, "a", "b", "c", "d", "e"]
    sizes = {s: int(x) for s, x in zip(sources, [5, 400, 3, 90, 2000, 60])}
    rows = []
    for s, total in sizes.items():
        while total > 0:
            n = min(total, int(rng.integers(1, 60)))
            rows.append((None if rng.random() < 0.3 else int(rng.integers(0, 9)), " ".join(["w"] * n), s))
            total -= n
    rows += [(1, None, "a"), (1, "", "f")]
    got = mixing.mix_sources(spark, spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    order = sorted({r[2] for r in rows if r[2]}) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    size = {s: sum(len((t or "").split()) for _, t, x in rows if x == s) for s in order}
    left, target, open_ = 1.5 * sum(size.values()), {}, set(order)
    while True:  # cap, and share the excess anew
        level = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if level[s] > 2 * size[s]]
        if not over:
            target |= level
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
            open_.remove(s)
    taken = defaultdict(int)
    for r in got:
        assert abs(r.target - target[r.source]) < 1e-6 and r.source_size == size[r.source] and 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= 4 for s in order), (taken, target)


def test_pipeline_mix_of_repeated_rows(spark):
    import corpus_pipeline

    rows = [(None, "a b c d", "s", 7), (None, "e f g h", "s", 7), (5, "i j", "s", 2), (5, "k l m", "s", 1), (5, "k l m", "s", 1), (6, "", "s", 0), (6, None, "s", 0)]
    df = spark.createDataFrame([(i, t, "en", s, n, 1, "x", 3, "y") for i, t, s, n in rows], "doc_id long, text string, lang string, source string, n_chars long, taken int, words string, lap int, id string")
    got = corpus_pipeline.mix(spark, df, "").collect()
    assert got[0].asDict().keys() == set(df.columns)
    words = lambda xs: sorted(w for t in xs for w in (t or "").split())
    made = words(r.text for r in got)
    assert abs(len(made) - 24) <= 2 and set(made) <= set("abcdefghijklm") and all(made.count(w) <= (4 if w in "klm" else 2) for w in made)
    assert sum(not r.text for r in got) == 2 and all(r.taken == 1 and r.words == "x" and r.lap == 3 for r in got)
    assert all(r.n_chars == len(r.text or "") for r in got if r.text)
    assert corpus_pipeline.mix(spark, df.limit(0), "").count() == 0
    extra = corpus_pipeline.near_duplicates(spark, df.withColumn("node", F.lit(1)).withColumn("place", F.lit(2)).withColumn("at", F.lit(3)), "")
    assert extra.columns[-3:] == ["node", "place", "at"] and extra.count() == 6


def test_license_spans(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    texts = [
        "to the " * 60, "of the " * 40, "this work this work is dedicated this is dedicated dedicated to the the public", mit, mit.replace("hereby", "HEREBY at once").replace("a copy", "copy"), "free of charge to any person", mit[:40] + " x" * 30 + mit[40:],
        "GENERAL PUBLIC LICENSE", "general public  license general public license", "general public 'K' license", "all rights\nreserved. " * 2,
    ]
    got = {r.doc_id: r for r in license_scan.license_scan(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(11)] == ["", "", "", "mit", "mit", "", "", "gpl", "gpl", "", "reserved"]
    assert (got[3].score, got[8].n_base, got[8].first_word, got[8].last_word, got[10].n_base) == (1.0, 2, 0, 3, 2) and 0.6 <= got[4].score < 1 and got[6].score == 0
    twice = spark.createDataFrame([(None, mit), (None, mit), (None, None), (1, mit)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.labels) for r in license_scan.license_scan(spark, twice).collect()) == [("1", "mit"), ("None", ""), ("None", "mit"), ("None", "mit")]
    assert license_scan.license_scan(spark, twice.limit(0)).count() == 0


def test_merkle_walk(spark):
    rows = [("Alpha beta. Alpha beta. Gamma.", "Gamma. Alpha beta."), ("a. b. c.", "a.  b. c."), ("", "x"), ("a. b. c. d.", "a. b. X. d."), ("", ""), ("a b", "a b")]
    df = spark.createDataFrame(rows, "a string, b string")
    prints = merkle.with_prints(df, fa="a", fb="b")
    got = merkle.with_differences(merkle.with_likeness(prints, "fa", "fb", "near"), "a", "b", "lost").collect()
    assert [r.near for r in got] == [0.4, 1.0, 0.0, 0.675, 1.0, 1.0]
    assert [r.fa == r.fb for r in got] == [False, False, False, False, True, True] and [[x.paragraph for x in r.lost] for r in got] == [[], [], [], ["c. "], [], []]


def test_merkle_brute_force(spark):
    """Many rows of null and repeated ids, and sections of several paragraphs."""
    import re
    from collections import Counter

    rng = np.random.default_rng(8)
    base = [f"s{k} words. " for k in range(60)]
    rows = [(None if i % 3 == 0 else int(rng.integers(0, 80)), "".join(rng.choice(base, rng.integers(0, 40))) + "end\n" * (i % 2)) for i in range(120)]
    got = merkle.merkle_fingerprints(spark.createDataFrame([*rows, (None, None)], "doc_id long, text string")).collect()
    assert len(got) == 121

    def sections(text: str) -> list[list[str]]:
        out, own = [], []
        for p in re.findall(merkle.PARAGRAPH, text):
            own.append(hashlib.md5(p.rstrip(merkle.SPACE).encode()).hexdigest())
            if own[-1][-1] in "08":
                out, own = [*out, own], []
        return out + [own] * bool(own)

    by_id = Counter(i for i, _ in rows)
    nulls = [t for i, t in rows if i is None] + [""]
    prints = Counter((r.doc_id, r.fingerprint.split(":")[1]) for r in got)
    assert prints == Counter((i, ";".join(",".join(h[:8] for h in s) for s in sections(t or ""))) for i, t in [*rows, (None, None)])
    order = sorted({i for i in by_id if i is not None}, reverse=True)
    for i, after in zip(order, [*order[1:], None]):
        if by_id[i] == 1 and after is not None and by_id[after] == 1:  # both stand alone: the next text is known
            text, other = (next(t for j, t in rows if j == k) for k in (i, after))
            half = len(text) // 2
            row = next(r for r in got if r.doc_id == i)
            assert row.edited_sha256 == hashlib.sha256((text[: len(text) - half] + other[:half]).encode()).hexdigest()
    assert len(nulls) == sum(r.doc_id is None for r in got) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_chat_schemas_of_the_conversation(spark):
    tools = {"tools": [{"type": "function", "function": {"name": "f", "parameters": {"required": ["n"], "properties": {"n": {"type": "integer"}, "tags": {"type": "array"}, "any": {}}}}}, {"name": "g", "parameters": {"properties": {"x": {"type": "number"}}}}]}
    call = lambda name, k, **a: {"id": str(k), "name": name, "arguments": a}
    made = {"tool_calls": [call("f", 1, n=1, tags=[]), call("f", 2, n="1"), call("f", 3), call("g", 4, x=1.5), call("g", 5, x="a"), call("h", 6)]}
    rows = [(1, 0, "system", json.dumps(tools)), (1, 1, "assistant", "\n\t" + json.dumps(made)), (2, 1, "assistant", json.dumps(made)), (1, 2, "assistant", json.dumps({"tool_calls": [call("f", 7, n=2)]})), (1, 2, "assistant", json.dumps({"tool_calls": [call("f", 8)]}))]
    rows += [rows[3], (1, 3, "assistant", "{broken"), (1, 4, "system", "[1]"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_tools.format_chat(spark, df).collect()
    assert len(got) == len(rows)
    at = lambda c, t: sorted((r.n_calls, r.n_valid) for r in got if (r.conv_id, r.turn) == (c, t))
    assert at(1, 1) == [(6, 2)] and at(2, 1) == [(6, 0)] and at(1, 2) == [(1, 0), (1, 1), (1, 1)] and at(1, 3) == [(0, 0)]
    both = spark.createDataFrame([("f", ["n"], {}), ("h", None, None)], "name string, required array<string>, types map<string,string>")
    again = {(r.conv_id, r.turn): r.n_valid for r in chat_tools.format_chat(spark, df, both).collect()}
    assert again[1, 1] == 3 and again[2, 1] == 3
    assert chat_tools.format_chat(spark, df.limit(0)).count() == 0


def test_pages_made_up(spark):
    """Pages that the labeller has not seen, one with very many blocks among short ones, nulls and copies."""
    rng = np.random.default_rng(11)
    made = [html_lstm.made_up_page(rng) for _ in range(80)]
    long = "<nav><a href=/x>Home</a></nav><article>" + "".join(f"<p>Paragraph {i} of the article, with some words in it.</p>" for i in range(15_000)) + "</article>"
    rows = [(i, f"u{i}", page) for i, (page, _) in enumerate(made)] + [(100, "n", None), (101, "e", ""), (102, "l", long), (103, None, made[0][0]), (None, "x", made[0][0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")
    got = {r.page_id: r for r in html_lstm.extract_pages(spark, df).collect()}
    import html as h

    want = ["\n\n".join(" ".join(h.unescape(b).split()) for b in main) for _, main in made]
    assert sum(got[i].text == w for i, w in enumerate(want)) >= 74 and all(r.n_chars == len(r.text) for r in got.values())
    assert got[100].text == got[101].text == "" and got[102].text.count("\n\n") == 14_999 and got[103].text == got[0].text == got[None].text
    assert html_lstm.extract_pages(spark, df.limit(0)).count() == 0


def test_votes_brute_force():
    """Scores equal a plain loop over cosines, ties included."""
    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 30))) for _ in range(120)]
    x = quality_knn.Terms().matrix(pa.array([*texts, *texts[:20]]))  # twenty voters are there twice
    y = rng.integers(0, 2, 140)
    space = quality_knn.Space(x, y)
    asked = quality_knn.Terms().matrix(pa.array([None, "", *texts[:10], "w1 W2! w3."]))
    got = space.score(asked)
    z = asked * space.idf
    z = z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9) @ space.axes
    for i, v in enumerate(z):
        cos = [float(v @ w) / max(float(np.linalg.norm(v)), 1e-9) for w in space.voters]
        kth = sorted(cos, reverse=True)[quality_knn.NEIGHBOURS - 1]
        votes = [(max(c, 1e-3) ** 8, label) for c, label in zip(cos, y) if c >= kth - 1e-6]
        assert abs(got[i] - sum(w * label for w, label in votes) / sum(w for w, _ in votes)) < 5e-3
    assert np.array_equal(got, space.score(asked)) and ((got >= 0) & (got <= 1)).all()


def _linked(sets: list[np.ndarray], percent: int) -> list[int]:
    """The smallest number that links reach, of each set, by brute force."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if len(sets[i]) and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def test_rtree_forest():
    """Three levels and more: forests over points, verified by whole sets, join what brute force joins; sides are kept apart."""
    rng = np.random.default_rng(5)
    base = [rng.integers(0, 1 << 63, 90).astype(np.uint64) for _ in range(12)]
    sets = []
    for i in range(700):
        s = base[i % 12].copy()
        k = int(rng.integers(0, 16))
        s[rng.choice(90, k, replace=False)] = rng.integers(0, 1 << 63, k).astype(np.uint64)
        sets.append(np.unique(s[: 90 - i % 7]))
    n, comp = np.array([len(s) for s in sets]), np.arange(700)
    points = [near_join.counts_of(near_join.point(s)) for s in sets]
    assert all(p.sum() == len(s) for p, s in zip(points, sets))
    none = np.full((700, near_join.EARLIER), near_join.NONE)
    tree = near_join.RTree(n, comp, points, none)
    assert len(tree.levels) >= 3
    overlap = lambda i, j: len(np.intersect1d(sets[i], sets[j]))
    pairs = list(tree.forest(75, overlap))
    assert len(pairs) < 700 and all(100 * overlap(i, j) >= 75 * (n[i] + n[j] - overlap(i, j)) for i, j in pairs)
    want = _linked(sets, 75)
    root = list(range(700))
    for _ in range(700):
        before = list(root)
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
        if root == before:
            break
    assert root == want and len(set(want)) > 12
    side = (np.arange(700) % 2).astype(np.int64)
    assert all(side[i] != side[j] for i, j in near_join.RTree(n, comp, points, none, side).forest(75))


def test_near_join_tiles(spark, monkeypatch):
    """Buckets beyond a cell are tiled; chains at the edge of 75 % hold; a frequent bucket is dealt by node; copies and nulls."""
    monkeypatch.setattr(near_join, "CELL", 40)
    monkeypatch.setattr(near_join, "FREQUENT", 20)
    rng = np.random.default_rng(13)
    rows: list[tuple] = [(None, None), (None, ""), (None, "one two"), (900, "one two"), (901, "ONE two")]
    for g in range(2):
        words = [f"g{g}w{i}" for i in range(60)]
        for i in range(130):
            w = words.copy()
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(60))] = f"x{rng.integers(10_000)}"
            rows.append((1000 * (g + 1) + i, " ".join(w)))
    rows += [(None if i % 2 else 5000, rows[8][1]) for i in range(30)]
    chain = [f"c{i}" for i in range(400)]
    rows += [(6000 + i, " ".join(chain[8 * i : 8 * i + 60])) for i in range(40)]  # each links with its neighbours only
    sets = common.shingle_sets(pa.array([t for _, t in rows], pa.string()))
    want = _linked(sets, 75)
    smallest = {}
    for (i, _), w, s in zip(rows, want, sets):
        if i is not None and len(s):
            smallest[w] = min(smallest.get(w, i), i)
    expected = sorted(str((i, len(s), smallest.get(w) if len(s) else i)) for (i, _), w, s in zip(rows, want, sets))
    got = near_join.near_join(spark, spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int"))
    assert sorted(str(tuple(r)) for r in got.collect()) == expected
    assert near_join.near_join(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_driver_is_left_clean(spark, monkeypatch):
    """The near join's broadcasts go with it, and a written table is followed by a collection once the driver's heap is large."""
    sent, send = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x: sent.append(send(x)) or sent[-1])
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(i % 3, 30))) for i in range(9)], "doc_id long, text string")
    rows = near_join.near_join(spark, docs).collect()
    assert len(rows) == 9 and sent and not any(b._jbroadcast.isValid() for b in sent)

    def collections():
        return [b.getCollectionCount() for b in spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans() if "Old" in b.getName() or "MarkSweep" in b.getName()]

    before = collections()
    monkeypatch.setattr(common, "HEAP_SHARE", 0)
    assert common.stash(spark, docs, "t").count() == 9 and sum(collections()) > sum(before)
