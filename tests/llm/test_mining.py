"""Hard negatives, secret scan and Merkle manifest against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reachlens.llm import hard_negatives, merkle, secret_scan

# hard negatives


def plain_mine(rows, anchor, positives=5, negatives=10):
    """rows: (id, vector, label); one result a row that is an anchor."""
    ok = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, y in ok:
        if i is None or not anchor(i):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, z) for j, w, z in ok if j != i))
        for s, none, j, _ in [x for x in scored if x[3] == y][:positives]:
            hits = [x for x in scored if x[3] != y and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(i, None if none else j, k + 1, None if n else m, -s, -t) for k, (t, n, m, _) in enumerate(hits)]
    return sorted(out, key=str)


def mined(df, **options):
    return sorted((tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 10 == 0, **options).collect()), key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3.0) for r in rows], "vec_id long, embedding array<double>, label int, block int, rid string, place int, score double")


def test_residues_give_exact_signed_scores():
    rng = np.random.default_rng(1)
    for dims, size in ((1, 3), (64, 300), (200, 5000), (65, 2 ** 22), (3, 2 ** 29)):
        a, b = rng.integers(-size, size + 1, (7, dims)), rng.integers(-size, size + 1, (9, dims))
        got = hard_negatives.exact_scores(hard_negatives.Vectors(a.astype(float)), hard_negatives.Vectors(b.astype(float)))
        assert (got.astype(object) == a.astype(object) @ b.astype(object).T).all()
    far = hard_negatives.Vectors(np.full((1, 4), 2.0 ** 31))
    with pytest.raises(ArithmeticError):
        hard_negatives.exact_scores(far, far)
    none = hard_negatives.exact_scores(hard_negatives.Vectors(np.zeros((2, 0))), hard_negatives.Vectors(np.ones((3, 4))))
    assert none.shape == (2, 3) and not none.any()


@pytest.mark.parametrize("blocks", [1, 3])
def test_mining_matches_brute_force(spark, monkeypatch, blocks):
    rng = random.Random(blocks)
    rows = [(i, [rng.gauss(0.2, 0.3) for _ in range(6)], rng.choice([0, 0, 1, 2])) for i in range(150)]
    rows += [(200 + i, [0.5] * 6, i % 2) for i in range(40)]  # equal scores
    rows += [(300, None, 1), (301, [0.1, None], 1), (302, [float("nan")] * 6, 0), (303, [float("inf")] * 6, 0), (304, [0.3] * 6, None), (None, [0.4] * 6, 1),
             (310, [0.5, 0.5], 0), (320, [], 1), (330, [900.0, -700.5, 0.0, 1.0, 2.0, 3.0], 1), (340, [0.2] * 6, 7), (10, [0.3] * 6, 0), (10, [0.3] * 6, 0)]
    rng.shuffle(rows)
    if blocks > 1:
        monkeypatch.setattr(hard_negatives, "ANCHORS", len(rows) // (blocks * blocks))
    assert mined(vectors(spark, rows)) == plain_mine(rows, lambda i: i % 10 == 0)


def test_mining_of_hardly_anything(spark):
    assert mined(vectors(spark, [])) == []
    assert mined(vectors(spark, [(0, [1.0], 0)])) == []
    assert mined(vectors(spark, [(0, [1.0], 0), (1, [1.0], 0), (2, [0.5], 1)])) == [(0, 1, 1, 2, 65536, 32768)]


# secret scan

def plain_spans(text):
    """Base spans and bare words: (kind, start, end, value)."""
    out = []
    for m in re.finditer(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 8:
            out.append((0, m.start(), m.end(), m.group(2)))
    out += [(1, m.start(), m.end(), m.group()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [(2, m.start(), m.end(), m.group()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    base = list(out)
    for m in re.finditer("[A-Za-z0-9+/_.-]{8,}", text):
        if re.search("[0-9]", m.group()) and re.search("[A-Za-z]", m.group()) and not any(s < m.end() and e > m.start() for _, s, e, _ in base):
            out.append((3, m.start(), m.end(), m.group()))
    return out


def plain_scan(rows):
    """rows: (doc_id, text, owner, repository) -> doc_id: (counts, digest, spans, added, copied, live)"""
    seen = {}
    each = [(i, o, r, plain_spans(t or "")) for i, t, o, r in rows]
    key = lambda v: re.sub("[.=]+$", "", v)
    for _, o, r, spans in each:
        for k, _, _, v in spans:
            x = seen.setdefault(key(v), [set(), set(), False])
            x[0].add(o)
            x[1].add((o, r))
            x[2] |= k == 0
    out = []
    for i, _, _, spans in each:
        stay = []
        for k, s, e, v in sorted(spans, key=lambda x: (x[1], x[0], x[2])):
            owners, repos, assigned = seen[key(v)]
            copied = len(owners) > 2 or (len(owners) > 1 and len(repos) > 4)
            long = len(v) >= 20 and re.search("[A-Z]", v) and re.search("[a-z]", v)
            if k < 3 or (not copied and (assigned or long)):
                stay.append((k, f"{secret_scan.KINDS[k]}:{s}:{e}", copied))
        own = ",".join(w for k, w, _ in stay if k < 3)
        out.append((i, *[sum(k == n for k, *_ in stay) for n in range(3)], hashlib.sha256(own.encode()).hexdigest(), ",".join(w for _, w, _ in stay),
                    sum(k == 3 for k, *_ in stay), sum(c for *_, c in stay), sum(not c for *_, c in stay)))
    return sorted(out, key=str)


def test_secret_scan_matches_brute_force(spark):
    rng = random.Random(3)
    hexa, key = "0123456789abcdef" * 2 + "ab", "AKIA" + "A1B2C3D4E5F6"
    texts = [None, "", "token=abcdefgh", "secret=token:12345678", "PassWord'  : \"s3cr3t-Value+/=.\" and again", "api_key=x apikey = abcd1234==", f"é😀 token = \"{hexa}\" ß {hexa}",
             key, key[:15], f"x{key}x AKIAAKIA1", "AKIAshort " + hexa[:31] + " " + hexa.upper(), "bare s3cr3t-Value+/ here", "Abcdefghij0123456789XYZ alone", "abcd1234.",
             "token==abcdefg9 tokentoken:abcdefgh12", "ToKen:\n12345678 token:\t12345678", "Kelvin Key ſecret=abcdefgh", "a" * 50_000 + "1 token=" + "Z9" * 20_000,
             "token=abcdefgh9 " * 3_000, "api__key=abcdefgh passwdpassword=abcdefgh8", "SharedExample0123456789ab"]
    rows = [(i, t, f"o{i % 4}" if i % 7 else None, rng.choice(["r", "s", None])) for i, t in enumerate(texts)]
    rows += [(100 + i, "SharedExample0123456789ab and token=sharedexample1", f"p{i % 40}", "r") for i in range(60)]
    rows += [(200 + i, "twoOwnersOnly0123456789 sharedexample1", f"q{i % 2}", f"r{i % 6}") for i in range(12)] + [(5, "token=abcdefgh", "o1", "r")] * 2 + [(None, key, None, None)]
    df = spark.createDataFrame([(*r, 1, "h", 2) for r in rows], "doc_id long, text string, source string, lang string, rid int, hash string, kind int")
    got = secret_scan.digests(secret_scan.scan(df, F.col("source"), F.col("lang")))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_scan(rows)
    assert secret_scan.digests(secret_scan.scan(df.limit(0), F.col("source"), F.col("lang"))).collect() == []


# Merkle manifest

def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([hashlib.sha256("".join(levels[-1][i:i + 16]).encode()).hexdigest() for i in range(0, len(levels[-1]), 16)])
    return levels


def plain_path(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 16 * 16:i // 16 * 16 + 16]
        out.append((i % 16, run[:i % 16] + run[i % 16 + 1:]))
        i //= 16
    return out


def plain_leaf(row):
    return hashlib.sha256("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row).encode()).hexdigest()


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    by = {}
    for r in rows:
        small = r[4] and re.sub("[A-Z]", lambda m: m.group().lower(), r[4])
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, plain_leaf(r), plain_leaf((*r[:4], small)) if tampered else None, r[0]))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(by[s], key=lambda x: (x[:3], x[3] or "")),) for s in order}
    trees = {s: (x, plain_levels([y[2] for y in x])) for s, (x,) in trees.items()}
    top = plain_levels([trees[s][1][-1][0] for s in order])
    out = []
    for n, s in enumerate(order):
        leaves, levels = trees[s]
        for i, (_, _, leaf, other, doc) in enumerate(leaves):
            path = plain_path(levels, i) + plain_path(top, n)
            fold = other or leaf
            for place, others in path:
                fold = hashlib.sha256("".join(others[:place] + [fold] + others[place:]).encode()).hexdigest()
            proof = hashlib.sha256("".join(d for _, others in path for d in others).encode()).hexdigest()
            out.append((doc, leaf, levels[-1][0], top[-1][0], proof, fold, fold == top[-1][0]))
    return sorted(out, key=str)


def manifest(spark, rows):
    df = spark.createDataFrame([(*r, 1, "t", 2) for r in rows], "doc_id long, source string, lang string, n_chars int, text string, tree int, digest string, n long")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.leaf_digest([*fields, small]))
    return merkle.build(df, merkle.leaf_digest([*fields, F.col("text")]), F.col("source"), changed=changed)


def test_addresses_are_one_to_one():
    for levels in (1, 2, 3, 4):
        seen = [merkle.address(levels, depth, i) for depth in range(levels) for i in range(16 ** depth)]
        assert sorted(seen) == list(range(merkle.tree_size(levels)))
    # a parent and its sixteen children stand together at the bottom
    first = merkle.address(4, 2, 5)
    assert [merkle.address(4, 3, 5 * 16 + k) for k in range(16)] == list(range(first + 1, first + 17))


def test_manifest_matches_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, "hot", rng.choice(["en", None]), i, f"Text {i}") for i in range(4500)]  # two blocks, the second one short
    rows += [(10_000 + i, "b", "en", None, rng.choice([None, "", "ABC é😀", "long " * 5000])) for i in range(17)]
    rows += [(20_000 + i, f"one{i}", "xx", 3, "A") for i in range(40)] + [(20_500, None, None, None, None), (None, "b", None, None, None), (None, "b", None, None, None), (7, "hot", "en", 7, "again"), (30_000, "", "en", 1, "E"), (30_001, "é", "en", 1, "E")]
    rng.shuffle(rows)
    m = manifest(spark, rows)
    assert len(m.tiers) == 2
    got = sorted((tuple(r) for r in m.checked().collect()), key=str)
    assert got == plain_manifest(rows)
    assert m.root() == got[0][3]


def test_manifest_of_hardly_anything(spark):
    one = [(5, "s", "en", 1, "A")]
    m = manifest(spark, one)
    assert [tuple(r) for r in m.checked().collect()] == plain_manifest(one) and m.root() == plain_leaf(one[0])
    empty = manifest(spark, [])
    assert empty.checked().collect() == [] and empty.root() is None
