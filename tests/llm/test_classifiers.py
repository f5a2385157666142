import itertools
import random

import numpy as np
import pytest

from chainfeatures.llm import learn
from chainfeatures.llm import quality as Q
from chainfeatures.llm import toxicity as T

SF = "/root/testdata/sf0.01"
NONE = np.empty(0, np.uint64)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    lexicon = [(b"idiot", False), (b"moron", False), (b"scum", False), (b"lowei", True), (b"pathetic", False), (b"disgust", True)]
    auto = T.Automaton(lexicon)
    r = random.Random(8)
    tokens = {b"idiot", b"IDIOT", b"id1ot", b"idiots", b"idot", b"iidiot", b"scum", b"scun", b"loweischaft", b"lowen", b"patheticc", b"disgusting", b"disgvsting", b"a", b"x" * 300}
    for w, _ in lexicon:
        for _ in range(150):
            x = bytearray(w)
            for _ in range(r.randint(0, 3)):
                k = r.randint(0, len(x))
                what = r.random()
                if what < 0.4 and x:
                    x[min(k, len(x) - 1)] = r.choice(b"abcdeimnost1")
                elif what < 0.7 and len(x) > 1:
                    del x[min(k, len(x) - 1)]
                else:
                    x.insert(k, r.choice(b"abcdeimnost1"))
            tokens.add(bytes(x))
    tokens = sorted(tokens)
    buf = b" ".join(tokens)
    from chainfeatures.llm.words import ALPHANUMERIC, words
    h, s, e = words(buf, ALPHANUMERIC)
    a = np.frombuffer(buf, np.uint8)
    got = auto.match(a, s, e)
    for k, t in enumerate(buf.split(b" ")):
        t = t.lower()
        want = False
        for w, stem in lexicon:
            most = 1 if len(w) >= (T.FUZZY_STEM if stem else T.FUZZY_WORD) else 0
            heads = [t[:n] for n in range(len(t) + 1)] if stem else [t]
            want |= any(distance(x, w) <= most for x in heads)
        assert (got[k] >= 0) == want, t


def test_quotation_and_abuse_differ():
    lexicon = [(b"idiot", False), (b"moron", False)]
    auto = T.Automaton(lexicon)
    f = T.features([b"you are an idiot and a moron", b'the report said "idiot" is a word', "elle a dit « moron » hier".encode(), b""], auto, NONE)
    abuse, quoted = f[:, T.FEATURES.index("abuse")], f[:, T.FEATURES.index("quoted")]
    assert abuse[0] > 0 == quoted[0] and abuse[1] == abuse[2] == 0 < min(quoted[1], quoted[2]) and not f[3].any()
    far = "said " * 10 + "x " * 100 + "idiot"
    assert T.features([far.encode()], auto, NONE)[0, 1] == 0


@pytest.mark.parametrize("around", ["{}…", "…{}", "{}—x", "x—{}", "¡{}!", "¿{}?", "l’{}", "{}’s", "“{}”", "„{}“", "«{}»", "‹{}›", "‘{}’", "»{}«", "x–{}–x", "{}\u00a0!", "\u2003{}"])
def test_terms_next_to_marks_of_any_kind(around):
    auto = T.Automaton([(b"idiot", False), ("débile".encode(), False), (b"disgus", True)])
    for word, term, edits in [("idiot", 0, 0), ("Idoit", None, 0), ("idiots", 0, 1), ("débile", 1, 0), ("DÉBILE", 1, 0), ("debile", 1, 1), ("disgusting", 2, 0)]:
        text = "ñ " + around.format(word) + " end"
        (_, _, found), = T.hits([text.encode()], auto, NONE)
        assert [(t, d, text.encode()[s:e].decode()) for _, t, d, s, e in found] == ([] if term is None else [(term, edits, word)]), text


def test_unspaced_quotes_are_quotation():
    auto = T.Automaton([(b"idiot", False)])
    f = T.features([q.encode() for q in ("mot «idiot» fin", "the “idiot” word", "das „idiot“ da", "a ‘idiot’ b", "you idiot…")], auto, NONE)
    abuse, quoted = f[:, T.FEATURES.index("abuse")], f[:, T.FEATURES.index("quoted")]
    assert (quoted[:4] > 0).all() and not abuse[:4].any() and abuse[4] > 0 == quoted[4]


def test_exempt_near_misses_by_folded_word():
    auto = T.Automaton([("débile".encode(), False)])
    exempt = np.sort(T._hashes(["debile", "débilé"]))
    texts = ["“Debile” DÉBILÉ… débile".encode(), b"debile"]
    assert [[d for _, _, d, _, _ in found] for _, _, found in T.hits(texts, auto, exempt)] == [[0], []]


def test_automaton_by_code_point_equals_edit_distance():
    lexicon = [("crétin".encode(), False), ("übelst".encode(), True), ("дурак".encode(), False), ("Σκύλος".encode(), False), ("白痴".encode(), False)]
    auto, r, tokens = T.Automaton(lexicon), random.Random(3), set()
    for w, _ in lexicon:
        for _ in range(150):
            x = list(w.decode())
            for _ in range(r.randint(0, 2)):
                k = r.randrange(len(x))
                x[k:k + r.randint(0, 1)] = r.choice(["", "é", "e", "у", "白", "ß", "ab"])
                x = x or ["x"]
            tokens.add("".join(c.upper() if r.random() < 0.3 and len(c.upper()) == 1 else c for c in x))
    tokens = sorted(t for t in tokens if t)
    (_, n, found), = T.hits([" ".join(tokens).encode()], auto, NONE)
    got = {k for k, *_ in found}
    assert n == len(tokens)
    for k, t in enumerate(tokens):
        t, want = T.fold(t), False
        for w, stem in lexicon:
            w = T.fold(w.decode())
            most = 1 if len(w) >= (T.FUZZY_STEM if stem else T.FUZZY_WORD) else 0
            want |= any(distance(x, w) <= most for x in ([t[:n] for n in range(len(t) + 1)] if stem else [t]))
        assert (k in got) == want, t


def _scored(spark, module, fn, label):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = fn(docs, labels).toPandas()
    assert len(out) == docs.count() and out["score"].between(0, 1).all() and ((out["score"] >= 0.3) == out["predicted"]).all()
    import zlib
    assert (out["held_out"] == [zlib.crc32(str(i).encode()) % module.MODULUS == module.HELD_OUT for i in out["doc_id"]]).all()
    x = out.merge(labels.toPandas(), on="doc_id")
    x = x[x["held_out"]]
    return x["predicted"], x[label]


def test_quality_on_held_out(spark):
    p, y = _scored(spark, Q, Q.quality, "quality")
    assert (p == y).mean() >= 0.97


def test_toxicity_on_held_out(spark):
    p, y = _scored(spark, T, T.toxicity, "toxic")
    assert p[y == 1].mean() >= 0.6 and p[y == 0].mean() <= 0.04


@pytest.mark.parametrize("fn", [Q.quality, T.toxicity])
def test_edges(spark, fn, edge_docs, no_docs, labels):
    got = fn(edge_docs, labels).toPandas()
    assert len(got) == edge_docs.count() and got["score"].between(0, 1).all() and not got[got["doc_id"].isna()]["held_out"].any()
    both = got[got["doc_id"] == 10]["score"]
    assert both.nunique() == 1
    assert fn(no_docs, labels).count() == 0
    none = fn(edge_docs, labels.limit(0)).toPandas()
    assert len(none) == len(got) and none["score"].notna().all()


def test_scores_ignore_ids_and_columns(spark, labels):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = Q.Model(np.zeros(Q.features([b"a"]).shape[1]), np.ones(Q.features([b"a"]).shape[1]), np.ones(Q.features([b"a"]).shape[1]), 0.0)
    assert model.score([b"same", b"same"]).std() == 0
    assert set(docs.columns) >= {"lang", "source"}


def test_bradley_terry_recovers_an_order():
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 3))
    y = (x @ np.array([2.0, -1.0, 0.0]) + 0.3 * r.normal(size=400) > -1).astype(int)
    m = Q.fit(x, y)
    z = ((x - m.mean) / m.scale) @ m.weights
    assert m.weights[0] > 0 > m.weights[1] and abs(m.weights[2]) < 0.2 * m.weights[0]
    assert ((z >= m.cut) == (y == 1)).mean() > 0.9


def test_logistic_finds_the_optimum():
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 2))
    y = (r.random(300) < learn.sigmoid(x @ np.array([1.0, -2.0]) + 0.5)).astype(float)
    w = learn.logistic(x, y, l2=0.1)
    loss = lambda v: -np.sum(y * np.log(learn.sigmoid(x @ v[:2] + v[2])) + (1 - y) * np.log(1 - learn.sigmoid(x @ v[:2] + v[2]))) + 0.05 * (v[:2] ** 2).sum() + 5e-4 * v[2] ** 2
    for d in itertools.product((-1e-3, 0, 1e-3), repeat=3):
        assert loss(w) <= loss(w + np.array(d)) + 1e-9


def test_lexicon_takes_short_and_long_words_and_any_number(spark):
    """Two-letter terms (exact only), terms of 40 letters, and more terms than one round or six find."""
    long_word = "grob" * 10
    terms = ["zq", long_word] + [f"vile{chr(97 + k % 26)}{chr(97 + k // 26)}x" for k in range(30)]
    toxic = [(f"some words {t} here {i}", 1) for t in terms for i in range(30)]
    clean = [(f"some words are here {i} zx zqa {long_word[:-1]}", 0) for i in range(3000)]
    lexicon = T.learn_lexicon(spark.createDataFrame(toxic + clean, "text string, label int"))
    exact = {b.decode() for b, s in lexicon if not s}
    stems = [b.decode() for b, s in lexicon if s]
    assert {"zq", long_word} <= exact and all(t in exact or any(t.startswith(s) for s in stems) for t in terms)
    auto = T.Automaton(lexicon)
    found = [bool(f) for _, _, f in T.hits([t.encode() for t in ("a zq b", "a zx b", "zqa", long_word, long_word[:-1])], auto, np.empty(0, np.uint64))]
    assert found == [True, False, False, True, False]
