"""No caps: many vector lengths, any page id, many spans before a candidate. Bounded work in a worker."""

import os
import random

import corpus_pipeline
import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from epistand.llm import jaccard_join, lm_score, pii, sentencepiece_ffbs, token_files, vector_join, warc
from epistand.llm.langid import text_parts
from epistand.session import ensure_checkpoint_dir


def test_vectors_of_many_lengths(spark):
    rng = random.Random(2)
    rows, key = [], 0
    for dim in range(1, 91):
        base = [rng.uniform(-1, 1) for _ in range(dim)]
        for scale, noise in ((1.0, 0.0), (3.0, 0.0), (1.0, 5.0)):
            rows.append((key, [scale * x + noise * rng.uniform(-1, 1) for x in base]))
            key += 1
    got = {r.vec_id: r for r in vector_join.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b, strict=True)) / (sum(x * x for x in a) ** 0.5 * sum(y * y for y in b) ** 0.5)

    for key, e in rows:
        links = [k for k, f in rows if k != key and len(f) == len(e) and cosine(e, f) >= 0.9]
        assert got[key].n_links == len(links), key
    assert got[1].component_id == 0


def test_a_length_of_many_vectors_beside_rare_ones(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(300)] + [(1000, [1.0, 2.0]), (1001, [2.0, 4.0]), (1002, [5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    order = lambda d: sorted(tuple(r) for r in d.collect())
    assert order(vector_join.link_vectors(df, block_rows=40, cell_rows=30)) == order(vector_join.link_vectors(df))


def test_any_page_id_has_a_valid_date(spark, tmp_path):
    ids = [0, 5, 300_000_000_000, 9007199254740993, 1 << 62, (1 << 63) - 1, -7, None]
    pages = spark.createDataFrame([(i, f"http://a.org/{i}", f"text {i}") for i in ids], "page_id long, url string, html string")
    got = warc.roundtrip(pages, str(tmp_path / "w")).collect()
    assert sorted((r.page_id for r in got), key=str) == sorted(ids, key=str)
    assert all(len(r.ts) == 20 and "2020" <= r.ts[:4] <= "2120" for r in got)


def test_a_long_span_before_many_short_ones():
    text = "a" + "1.1.1.1" * 1 + ".".join(["x1.1.1.1"] * 12) + " 4111-1111-1111-1112@example.org and 4111 1111 1111 1112"
    text = ".".join(["1.1.1.1x"] * 12) + "4111-1111-1111-1112@example.org, card 4111 1111 1111 1112"
    strict = pii.strict_spans(text)
    email = next(s for s in strict if s[0] == 0)
    assert email[1] == 0 and sum(s[0] == 1 for s in strict) == 12
    loose = list(pii.loose_spans(text, strict))
    assert all(s >= email[2] for _, s, _ in loose) and any(k == 2 for k, _, _ in loose)


def test_lattices_of_much_text_stay_small():
    import tracemalloc

    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + i) for i in rng.integers(0, 26, n)) for n in rng.integers(2, 9, 30_000)]
    texts = [" ".join(words[i] for i in rng.integers(0, len(words), 400)) for _ in range(1000)]
    pieces = sentencepiece_ffbs.load_pieces()
    encode = lambda part: sentencepiece_ffbs.encode_block(part, np.zeros(len(part), np.int64), pieces)
    encode(texts[:1])  # tables that are built once
    tracemalloc.start()
    for part in text_parts(pa.array(texts), sentencepiece_ffbs._BLOCK):
        ids, count = encode(part)
        assert [b.decode() for b in sentencepiece_ffbs.decode_block(ids, count, pieces)] == part
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6, peak


def test_blocks_of_lattices_take_little_memory():
    import tracemalloc

    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(300)) for _ in range(300)]
    pieces = sentencepiece_ffbs.load_pieces()
    sentencepiece_ffbs.encode_block(texts[:1], np.zeros(1, np.int64), pieces)  # tables that are built once
    tracemalloc.start()
    for part in text_parts(pa.array(texts), sentencepiece_ffbs._BLOCK):
        sentencepiece_ffbs.encode_block(part, np.zeros(len(part), np.int64), pieces)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6, peak


def test_tables_made_in_the_driver_are_not_sent_with_functions():
    sentencepiece_ffbs.load_pieces()  # makes tables of powers here
    for f in (sentencepiece_ffbs.encode_block, jaccard_join.shingle_sets):
        assert len(cloudpickle.dumps(f)) < 1_000_000


def test_the_token_stage_sends_few_rows_at_a_time(spark, monkeypatch):
    def counted(column, limit):
        assert len(column) <= 1000
        return text_parts(column, limit)

    monkeypatch.setattr(sentencepiece_ffbs, "text_parts", counted)
    docs = spark.range(2500).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"))
    rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = corpus_pipeline.tokens(spark, docs.coalesce(1), "").where("lossless and n_pieces > 0").count()
    assert got == 2500 and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == rows


def test_a_distinct_piece_is_looked_up_once_a_block(monkeypatch):
    import public_tokenizers

    class Counted(dict):
        asked = 0

        def get(self, *a):
            Counted.asked += 1
            return super().get(*a)

        def __contains__(self, k):
            Counted.asked += 1
            return super().__contains__(k)

        def __getitem__(self, k):
            Counted.asked += 1
            return super().__getitem__(k)

    coder = token_files.PieceTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    coder.known = Counted()
    for texts in (["one two three", "two one", ""], ["three four", "one"]):
        raw = [t.encode() for t in texts]
        offsets = np.cumsum([0, *map(len, raw)])
        ids, counts = coder.encode(np.frombuffer(b"".join(raw), np.uint8), offsets, 2)
        want = [coder.tok.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        assert ids.tolist() == sum(want, []) and counts.tolist() == [len(w) for w in want]
    assert Counted.asked == 8  # "one", " two", " three", "two", " one"; "three", " four", "one"


def test_tables_that_nothing_reads_any_more_are_deleted(spark):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    rng = random.Random(4)
    texts = [" ".join(str(rng.randrange(900)) for _ in range(60)) for _ in range(40)]
    texts += [t + f" x{i}" for i, t in enumerate(texts)] + texts[:5]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words=3, num=90)
    got = {r.doc_id: r.component_id for r in got.collect()}
    sets = [{tuple(w[i:i + 3]) for i in range(len(w) - 2)} for w in (t.split() for t in texts)]
    for i, s in enumerate(sets):
        assert got[i] == next(j for j, o in enumerate(sets) if 100 * len(s & o) >= 90 * len(s | o))
    left = {name.split("-")[1] for name in set(os.listdir(folder)) - before if name.startswith("llm-")}
    assert not left & {"common", "lists", "leaders", "pairs", "ids", "star", "needed", "sets", "again", "known", "mixed"}, left


def test_near_copies_that_just_fail_to_link_do_not_meet_in_pairs(spark, monkeypatch):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(300)]
    spots = list(range(10, 290))

    def copy(i, edits, like=()):
        words = list(base)
        for at in [*like, *rng.sample([s for s in spots if s not in like], edits)]:
            words[at] = f"v{at}" if at in like else rng.choice(["", f"x{i}.{at}", f"y{i}.{at} z{i}.{at}"])
        return " ".join(w for w in words if w)

    # 5 words, 0.8: with six words replaced a copy links with the base, with seven far from each other it doesn't
    texts = [" ".join(base)] + [copy(i, rng.randint(1, 4)) for i in range(60)] + [copy(i, rng.randint(8, 10)) for i in range(100, 180)]
    some = rng.sample(spots, 8)
    texts += [copy(i, 2, some) for i in range(200, 206)] + [copy(i, 3, some[:6]) for i in range(300, 306)]
    made, real = {}, jaccard_join.shared_table

    def counted(df, name):
        out = real(df, name)
        made.setdefault(name, []).append((out._shared_path.removeprefix("file:"), out.count() if name == "rest" else 0))
        return out

    monkeypatch.setattr(jaccard_join, "shared_table", counted)
    rows = list(enumerate(texts))
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words=5, num=80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()}
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    low = list(range(len(sets)))
    for _ in range(8):
        for a, s in enumerate(sets):
            low[a] = min(low[b] for b, o in enumerate(sets) if 100 * len(s & o) >= 80 * len(s | o))
    assert got == {i: (len(s), low[i]) for i, s in enumerate(sets)}
    assert len(set(low)) > 60 and any(low[i] not in (0, i) for i in range(len(sets)))
    assert sum(n for _, n in made["rest"]) <= len(sets)  # thousands of pairs lie close to the threshold
    for name in ("prefixes", "classes", "rest", "open", "compared"):
        assert not any(os.path.exists(path) for path, _ in made[name]), name


def many_words(spark, rows):
    words = "array_join(transform(sequence(1, 900), x -> concat('w', abs(hash(id, x)) % 5000)), ' ')"
    return spark.range(0, rows, 1, 1).select(F.col("id").alias("doc_id"), F.expr(words).alias("text"))


def test_scores_send_a_block_at_a_time(spark, monkeypatch):
    frame = type(spark.range(0))
    plain = frame.mapInArrow

    def watched(self, func, schema, *more):
        def sized(batches):
            for batch in batches:
                assert batch.nbytes < 6 << 20, (batch.num_rows, batch.nbytes)  # 1 MB and a block of 4 MB at most
                yield batch

        return plain(self, lambda batches: func(sized(batches)), schema, *more)

    monkeypatch.setattr(frame, "mapInArrow", watched)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = spark.conf.get(name, None)
    docs = many_words(spark, 2500)
    got = lm_score.score_texts(docs, docs["doc_id"] % 10 != 0).agg(F.count("score"), F.sum("n_tokens")).first()
    assert tuple(got) == (2500, 2500 * 901) and spark.conf.get(name, None) == size


def test_text_blocks_are_packed_over_batches_a_page_each(spark):
    docs = many_words(spark, 2500).withColumn("train", F.lit(True))  # 13 MB
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    spark.conf.set(rows, "100")
    try:
        blocks = lm_score.text_table(docs.unionByName(docs.limit(3).withColumn("text", F.lit(None).cast("string"))).coalesce(1))
        size = [r["size"] for r in blocks.select("size").collect()]
        assert len(size) == 4 and max(size) <= 2 * lm_score.BLOCK_BYTES
        assert sum(size) == docs.agg(F.sum(F.octet_length("text"))).first()[0]
        assert blocks.select(F.explode("ids")).count() == 2503 and blocks.select(F.explode("texts").alias("t")).where("t is null").count() == 3
    finally:
        spark.conf.set(rows, before)
    jvm, (name,) = spark._jvm, blocks.inputFiles()
    parquet = jvm.org.apache.parquet
    file = parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(name), spark._jsc.hadoopConfiguration())
    reader = parquet.hadoop.ParquetFileReader.open(file)
    columns = {c.getPath().toDotString(): c for c in reader.getFooter().getBlocks().get(0).getColumns()}
    reader.close()
    stats = next(c for path, c in columns.items() if path.startswith("texts.")).getEncodingStats()
    assert sum(stats.getNumDataPagesEncodedAs(e) for e in parquet.column.Encoding.values()) == 4


def test_grams_of_a_block_take_little_memory():
    import tracemalloc

    rng = random.Random(8)
    texts = pa.array([" ".join(f"w{rng.randint(0, 9999)}" for _ in range(600)) for _ in range(1200)])
    lm_score.BlockGrams(texts[:1])  # tables that are built once
    tracemalloc.start()
    grams = lm_score.BlockGrams(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert grams.texts == 1200 and len(grams.own) == 1200 * 601
    assert peak < 90e6, peak
