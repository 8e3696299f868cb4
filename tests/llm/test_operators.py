"""Small cases of each operator: nulls, empty and equal texts, repeated rows, extra columns, empty tables."""

import hashlib
import random
import re

import numpy as np
import pytest

from epistand.llm import exact_dedup, jaccard_join, langid, lm_score, mixing, pii, sentencepiece_ffbs, toxicity, vector_join, warc

DOCS = "doc_id long, text string, lang string, n long, keep_id string"
ROWS = [(1, "The Cat sat on the mat", "en", 1, "x"), (5, "the cat SAT on the mat", "en", 2, "x"), (5, "the cat SAT on the mat", "en", 2, "x"),
        (2, None, "en", 3, None), (3, "", None, 4, "y"), (None, "alone again", "de", 5, "z"), (7, "ÄPFEL und Birnen 12", "de", 6, "z")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_exact_dedup(docs, empty):
    got = {(r.doc_id, r.keep_id, r.group_size): r for r in exact_dedup.exact_dedup(docs, keep="largest").collect()}
    assert (1, 5, 3) in got and (2, 3, 2) in got and (None, None, 1) in got and (7, 7, 1) in got
    assert got[(2, 3, 2)].text_sha256 == hashlib.sha256(b"").hexdigest()
    rows = exact_dedup.drop_copies(docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "7", "None"]
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_jaccard_matches_brute_force(spark, docs):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(w if rng.random() > 0.01 else f"v{rng.random()}" for w in base)) for i in range(40)]
    rows += [(100 + i, f"common line here {i} " * 2) for i in range(10)] + [(200, None), (201, ""), (202, "one"), (203, "ONE")]
    got = {r.doc_id: r for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words=3,
                                                                 num=90, common=(1, 2, 4)).collect()}
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()
    low = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                    low[a] = min(low[a], low[b])
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(sets[i]), low[i]) for i in sets}


def test_pii_matches_plain_patterns():
    rng = random.Random(5)
    plain = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
             r"\+[0-9][\x20().0-9-]+[0-9]"]
    parts = ["a", "b.c", "@", "@", "1", "23", ".", ".", "-", " ", "+", "4539 1488 0343 6467", "5", "é", "(", "256", "\n"]
    for _ in range(4000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        want = []
        for k, p in enumerate(plain):
            for m in re.finditer(p, t):
                d = re.sub("[^0-9]", "", m.group())
                if [True, k == 1 and all(int(x) <= 255 for x in m.group().split(".")), 13 <= len(d) <= 19 and pii.luhn(d), 9 <= len(d) <= 15][k]:
                    want.append((k, *m.span()))
        assert sorted(pii.strict_spans(t)) == sorted(want), t


def test_pii_rows(spark, empty):
    df = spark.createDataFrame([(1, "mail me@x.org now"), (2, None), (2, None)], "doc_id long, text string")
    got = sorted((r.doc_id, [(s.kind, s.start, s.stop) for s in r.spans]) for r in pii.find_pii(df).collect())
    assert got == [(1, [("email", 5, 13)]), (2, []), (2, [])]
    assert pii.find_pii(empty).count() == 0


def test_loser_tree_merges():
    rng = random.Random(3)
    runs = [sorted((rng.randint(0, 30), i, j) for j in range(rng.randint(0, 20))) for i in range(7)]
    assert list(warc.loser_tree_merge(runs)) == sorted(x for r in runs for x in r)
    assert list(warc.loser_tree_merge([])) == []


def test_warc_roundtrip(spark, tmp_path):
    long = "<p>" + "é\r\n\r\nWARC/1.1" * 20
    rows = [(3, "http://b.org/x", long), (1, None, long), (2, "http://a.org/ y", ""), (4, "http://a.org/z", None), (None, "u", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.roundtrip(pages, str(tmp_path / "w")).collect()}
    assert (got[1].record_type, got[3].record_type, got[3].refers_to) == ("response", "revisit", 1)
    assert got[3].payload_bytes == len(long.encode()) and got[3].payload_digest == hashlib.sha256(long.encode()).hexdigest()
    assert got[4].record_type == got[2].record_type == "response" and len(got) == 5
    text = {r.page_id: r.payload for r in warc.read_warc(spark, str(tmp_path / "w"), with_payload=True).collect()}
    assert text[1] == long and text[3] is None and text[4] == ""
    assert warc.roundtrip(pages.where("false"), str(tmp_path / "none")).count() == 0


def test_lm_counts_and_scores(docs, empty):
    got = lm_score.score_texts(docs, docs["doc_id"].isNotNull(), filter_bytes=1 << 16).collect()
    assert len(got) == 7 and all(r.score < 0 and r.base_score < 0 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[2].n_tokens == 1 and by[5].n_known == 7 and by[None].held_out and by[1].train_tokens == 3 * 7 + 1 + 1 + 5
    assert lm_score.score_texts(empty, empty["doc_id"].isNotNull(), filter_bytes=1 << 16).count() == 0


def test_language_id(spark, empty):
    rows = [(i, "the house and the garden by the sea " * 4, "en") for i in range(30)]
    rows += [(100 + i, "das haus und der garten an der see " * 4, "de") for i in range(30)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(train)
    probe = spark.createDataFrame([(1, "the garden"), (2, "der garten und das"), (3, None), (4, "12 34"), (5, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(probe, model).collect()}
    assert [got[i].lang_pred for i in range(1, 6)] == ["en", "de", "und", "und", "und"]
    assert all(0 <= r.lang_score <= 1 for r in got.values()) and not got[3].lang_accepted
    assert langid.identify(probe, langid.train(empty)).where("lang_pred <> 'und'").count() == 0


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8))
    x = np.concatenate([x, x[:20] + rng.normal(scale=0.15, size=(20, 8)), x[:2], x[:1] * 3])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in vector_join.link_vectors(df, cell_rows=15, block_rows=10).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.9
    assert all(got[i].n_links == link[i].sum() - 1 for i in range(len(x)))
    low = np.arange(len(x))
    for _ in low:
        low = np.array([low[link[i]].min() for i in range(len(x))])
    assert [got[i].component_id for i in range(len(x))] == low.tolist()
    assert all(got[i].n_links == 0 and got[i].kept for i in (900, 901, 902, 903))


def test_toxicity(spark, empty):
    rows = [(i, f"you {'1d10t' if i % 4 == 0 else 'friend'} number {i} " + "fine words here " * (i % 5)) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    probe = spark.createDataFrame([(1, "such an IDIOT"), (2, "a kind friend"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score_toxicity(probe, model).collect()}
    assert got[1].toxic_predicted == 1 and got[2].toxic_predicted == got[3].toxic_predicted == got[4].toxic_predicted == 0
    assert toxicity.train(empty, labels.where("false")).terms == {}


def test_sentencepiece_is_lossless_and_reproducible(docs):
    pieces = sentencepiece_ffbs.load_pieces()
    texts = ["", None, "a", " ", "  hi  there\n\n a▁b", "日本😀\t\x00é", "hello world " * 50, "x" * 3000]
    ids, count = sentencepiece_ffbs.encode_block(texts, np.arange(len(texts)), pieces)
    assert [b.decode() for b in sentencepiece_ffbs.decode_block(ids, count, pieces)] == [t or "" for t in texts]
    coded = sentencepiece_ffbs.encode(docs)
    rows = coded.collect()
    assert all(r.lossless for r in rows) and len({tuple(r.piece_ids) for r in rows if r.doc_id == 5}) == 1
    assert sorted(r.text for r in sentencepiece_ffbs.decode(coded).select("text").collect()) == sorted(r[1] or "" for r in ROWS)


def test_mixing_meets_targets(spark, empty):
    rows = [(i, ("alpha beta " if i % 3 else "gamma delta ") * (1 + i % 4)) for i in range(300)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "a" if i % 3 else "g") for i in range(0, 300, 2)], "doc_id long, d string")
    got, report = mixing.mix(docs, labels, labels["d"], {"a": 0.5, "g": 0.5})
    assert np.allclose(report["after"], report["target"], rtol=1e-3)
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in got.collect())
    assert mixing.mix(empty, labels, labels["d"], {"a": 1.0})[0].count() == 0


def test_lm_scores_keep_every_pair(spark):
    # almost no false positives at this load; the filter needs far more than filter_bytes for all pairs
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["Sea", "sun", f"w{rng.randint(0, 400)}"]) for _ in range(rng.randint(0, 60)))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm_score.score_texts(docs, docs["doc_id"] % 4 != 0, filter_bytes=1 << 12, load=0.02).collect()}
    seqs = {i: ["<", *t.lower().split(), ">"] for i, t in rows}
    single, pair = {}, {}
    for s in (s for i, s in seqs.items() if i % 4):
        for a, b in zip(s, s[1:], strict=False):
            single[b] = single.get(b, 0) + 1
            pair[a, b] = pair.get((a, b), 0) + 1

    def middle(c):
        q = next((q for q in range(1, 100) if 1.5 ** q > c), 0) if c else 0
        return sum(lm_score.class_bounds(q, 1.5)) / 2 if q else 0.0

    n, v = sum(single.values()), len(single)
    for i, s in seqs.items():
        want = 0.0
        for a, b in zip(s, s[1:], strict=False):
            context = single[">"] if a == "<" else middle(single.get(a, 0))
            unigram = (middle(single.get(b, 0)) + 0.1) / (n + 0.1 * (v + 1))
            want += np.log10(min(1.0, (min(middle(pair.get((a, b), 0)), context) + 5 * unigram) / (context + 5)))
        assert got[i] == pytest.approx(want, abs=1e-6), i


@pytest.mark.parametrize("text", ["idiot!", "LOSER!!", "1d10t!!", "@idiot", "(L0SER!)", "such an idiot1 he is", "a $$loser$!"])
def test_toxicity_signs_at_the_edge_of_a_word(text):
    model = toxicity.ToxicityModel({"idiot": 2.0, "ioser": 2.0, "ioserii": 1.0}, {"idiot proof", "no ioser"})
    folded = toxicity.fold_texts([text, f"no {text}", "idiotic l0sers, 1! x!idiot!"], toxicity.fold_table())
    assert model.features(folded[0])[::2] == (2.0, 2.0)
    assert model.features(folded[1])[0] == (2.0 if "oser" not in folded[0] or "a " in folded[0] else 0.0)
    assert model.features(folded[2])[0] == 0.0
    assert model.features(toxicity.fold_texts(["1d10t!! -proof!"], toxicity.fold_table())[0])[0] == 0.0


def test_language_id_rejects_for_small_languages(spark):
    rows = [(i, "the house and the garden by the sea " * 4, "en") for i in range(30)]
    rows += [(100 + i, "das haus und der garten an der see " * 4, "de") for i in range(3)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    probe = spark.createDataFrame([(1, "zzrrzz ndndnd uuhhuu ssrrss ddtt " * 9), (2, "eeyyee bbnnbb ooggoo hhsshh ttyy " * 9), (3, "the house by the sea"),
                                   (4, "der garten und das haus")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(probe, model).collect()}
    assert [got[i].lang_accepted for i in range(1, 5)] == [False, False, True, True], got


def test_vectors_stored_twice_in_a_row(spark):
    x = np.random.default_rng(2).normal(size=(60, 8))  # representatives are all even
    df = spark.createDataFrame([(i, [float(v) for v in x[i // 2]]) for i in range(120)], "vec_id long, embedding array<double>").coalesce(1)
    got = {r.vec_id: r for r in vector_join.link_vectors(df, cell_rows=1000, block_rows=2).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.9
    assert [got[i].n_links for i in range(120)] == [2 * int(link[i // 2].sum()) - 1 for i in range(120)]
