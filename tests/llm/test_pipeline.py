"""Registered text queries and the pipeline."""

import hashlib
import os
import random
import re
import shutil
import zlib

import pytest

import corpus_pipeline
from reachlens.llm import mixing, queries
from tests.llm.test_dedup import plain_components, plain_fingerprint
from tests.llm.test_text import plain_measures, plain_targets

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "labels", "embeddings")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    import duckdb

    from tools.oracle_check import canon

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert canon(queries.QUERIES[name](spark, SF).toPandas()) == canon(con.execute(queries.ORACLE[name]).df())


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_stages(spark, tmp_path):
    """Each stage keeps the columns and works on what the one before kept; the last has whole documents."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] <= counts[2]
    want = sorted((r.doc_id, len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in before.collect())
    assert sum(n for _, n in want) == sum(r.length for r in docs.collect())
    assert {i for i, _ in want} == {r.doc_id for r in docs.collect()}


def test_pipeline_on_empty_documents(spark, tmp_path):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    source.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    shutil.copy(f"{SF}/labels.parquet", tmp_path / "labels.parquet")
    assert os.path.exists(tmp_path / "labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def plain_mix(rows):
    """Rows (doc_id, text, lang, source) as often as the mix takes them, by finish times of whole copies."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    targets, done, copies = plain_targets(sizes), dict.fromkeys(sizes, 0), []
    names = sorted(sizes)
    for row in sorted(rows, key=lambda r: (hashlib.md5(f"{r[0]}:{mixing.SEED}".encode()).hexdigest(), r[0])):
        s = row[3]
        done[s] += size(row[1])
        copies += [((done[s] + e * sizes[s]) / targets[s], names.index(s), e, done[s], row) for e in range(mixing.MAX_EPOCHS)]
    out, total = [], 0
    for *_, row in sorted(copies):
        total += size(row[1])
        if total <= sum(sizes.values()):
            out.append(row)
    return out


def test_run_is_the_plain_chain(spark, tmp_path):
    """The pieces of all five stages are those of a plain chain over the same rows."""
    from tokenizers import Tokenizer

    rng = random.Random(6)
    words = lambda n: ["".join(rng.choices("abcdef", k=rng.randint(2, 8))) for _ in range(n)]
    texts = [words(60) for _ in range(900)]
    labels = [(i, 1) for i in range(900)] + [(i, 0) for i in range(900, 960)]
    texts += [[w + "###" for w in words(60)] for _ in range(60)]  # rejected by the certified symbols rule
    texts += [words(rng.randint(1, 70)) for _ in range(40)] + [["a", "b", "c"] * 40]  # some too short, one repeats itself
    for _ in range(20):
        near = words(400)
        texts += [near, near[:200] + words(1) + near[201:]]
    rows = [(i, " ".join(t), "en", rng.choice(["a", "a", "b", "c"])) for i, t in enumerate(texts)]
    rows += [(2000 + i, rows[i][1].replace(" ", "\n", 3), "en", "b") for i in range(30)] + [(3000, None, "en", "a"), (3001, " ".join(words(5000)), "en", "c")]
    rng.shuffle(rows)
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))

    counts, kept = [len(rows)], []
    for r in rows:
        n, _, symbols, _, repeats = plain_measures(r[1])
        if n >= 50 and 100 * repeats <= 50 * n and symbols <= 2 * n:
            kept.append(r)
    counts.append(len(kept))
    first = {}
    for r in sorted(kept):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1]), r)
    kept = list(first.values())
    counts.append(len(kept))
    fps = [(r[0], plain_fingerprint(r[1])) for r in kept]
    kept = [r for r, c in zip(kept, plain_components(fps), strict=True) if r[0] == c]
    counts.append(len(kept))
    kept = plain_mix(kept)
    assert counts[0] > counts[1] > counts[2] > counts[3] and len(kept) > len(set(kept))  # every stage has work
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want = []
    for i, t, *_ in kept:
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = ids[k:k + 2048]
            want.append((i, k // 2048, k, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048
