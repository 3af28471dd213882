"""Exact, near and substring duplicates against plain versions."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
import xxhash

from reachlens.llm import exact_dedup, simhash, suffix_dedup
from reachlens.llm.common import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, name string, kept string, `row` int"


def table(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7, "n", "k", 1) for i, t in rows], SCHEMA)


def hard_rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 7)))
    shared = " ".join(word() for _ in range(60))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "A"), (6, "a  b"), (7, "a\tb"), (9, "x" * 70_000 + " tail"), (8, "x" * 70_000 + "\ntail"), (10, "x" * 70_000 + " tall")]
    for i in range(11, 70):
        words = [word() for _ in range(rng.randint(5, 80))]
        if i % 3 == 0:
            words[2:2] = [shared]
        if i % 7 == 0:
            words.append(shared[: rng.randint(40, 70)])
        rows.append((i, " ".join(words)))
    rows += [(200 + i, rows[20][1]) for i in range(30)]
    rows += [(5, "A"), (300, "ab" * 60), (301, "ab" * 40), (302, "\x00" * 60), (303, "\x00" * 60)]
    rng.shuffle(rows)
    return rows


def test_exact(spark):
    rows = hard_rows() + [(None, "a"), (None, "lone"), (None, "lone")]
    got = sorted(map(tuple, exact_dedup.exact_duplicates(table(spark, rows), block_bytes=64).collect()), key=str)
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for i, t in rows:
        groups[norm(t)].append(i)
    want = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        first = ids.index(keep)
        want += [(i, keep, len(ids), k == first, hashlib.sha256(text.encode()).hexdigest()) for k, i in enumerate(ids)]
    assert got == sorted(want, key=str)
    assert exact_dedup.exact_duplicates(table(spark, [])).count() == 0


def test_exact_hot_block(spark):
    """A block that makes up most rows is named apart, with the same result."""
    rows = [(i, "hot" if i % 3 else f"text {i}") for i in range(300)]
    got = {r.doc_id: r for r in exact_dedup.exact_duplicates(table(spark, rows)).collect()}
    assert all(got[i].keep_id == (1 if i % 3 else i) and got[i].group_size == (200 if i % 3 else 1) for i, _ in rows)


def test_exact_stage(spark):
    rows = hard_rows()
    kept = exact_dedup.drop_exact_duplicates(table(spark, rows), block_bytes=4096)
    assert kept.columns == table(spark, []).columns
    first = {}
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        first[key] = min(i, first.get(key, i))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values())


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """fps: (id, fingerprint); component by id."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 2:
                parent[find(i)] = find(j)
    low = {}
    for k, (i, _) in enumerate(fps):
        low[find(k)] = min(i, low.get(find(k), i))
    return [low[find(k)] for k in range(len(fps))]


def test_simhash(spark):
    rows = hard_rows()
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(table(spark, rows)).collect())
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    want = sorted((i, f"{f:016x}", c) for (i, f), c in zip(fps, plain_components(fps), strict=True))
    assert got == want
    assert simhash.near_duplicates(table(spark, [])).count() == 0


@pytest.mark.parametrize("bucket", [1, 4, 64])
def test_links_connect_what_is_near(spark, bucket):
    """Dense clusters, crowded buckets included, give the plain components."""
    rng = random.Random(bucket)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = set(base)
    for x in base:
        for _ in range(40):
            for b in rng.sample(range(64) if rng.random() < 0.5 else range(20, 34), rng.randint(1, 3)):
                x ^= 1 << b
            fps.add(x)
            x = rng.choice(base) if rng.random() < 0.2 else x
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket)
    roots = {r.v: r.root for r in connected_components(links).collect()}
    assert all(((r.a ^ r.b) & ((1 << 64) - 1)).bit_count() <= 2 for r in links.collect())
    plain = plain_components([(s, f) for s, f in zip(signed, fps, strict=True)])
    assert [roots.get(s, s) for s in signed] == plain


def test_simhash_stage(spark):
    rows = hard_rows()
    kept = sorted(r.doc_id for r in simhash.keep_one(table(spark, rows)).collect())
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    assert kept == sorted({i for (i, _), c in zip(fps, plain_components(fps), strict=True) if i == c})
    nulls = simhash.near_duplicates(table(spark, [(None, "a b c"), (5, "a b c"), (None, "other words here")])).collect()
    assert {(r.doc_id, r.component_id) for r in nulls} == {(None, 5), (5, 5), (None, None)}


def test_keep_one_of_repeated_ids(spark):
    a, b = "one text of some words", "another one that is quite different from it"
    rows = spark.createDataFrame([(1, a, 7), (5, a, 7), (5, b, 7), (5, b, 8), (None, b, 1), (None, "quite alone here", 1), (None, "quite alone here", 2)], "doc_id long, text string, `a.b` int")
    kept = simhash.keep_one(rows)
    assert kept.columns == rows.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "quite alone here"), (1, a), (5, b)]
    assert simhash.keep_one(rows.limit(0)).collect() == []


def plain_removed(rows):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    seen, out, k = set(), {}, 0
    while k < len(order):
        same = [x for x in order[k:] if rows[x][0] == rows[order[k]][0]]
        new = []
        for x in same:
            raw = (rows[x][1] or "").encode()
            gone = bytearray(len(raw))
            for j in range(len(raw) - 49):
                if raw[j:j + 50] in seen:
                    gone[j:j + 50] = b"\1" * 50
                new.append(raw[j:j + 50])
            spans = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
            out[x] = (rows[x][0], len(raw), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(raw, gone, strict=True) if not g)).hexdigest())
        seen.update(new)
        k += len(same)
    return sorted(out.values(), key=str)


@pytest.mark.parametrize("pack_bytes", [300, 1 << 20])
def test_suffix(spark, pack_bytes):
    rows = hard_rows() + [(None, "ab" * 60), (None, "q" * 55)]
    got = suffix_dedup.remove_repeats(table(spark, rows), pack_bytes=pack_bytes, bucket_bits=3, with_kept=True)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == plain_removed(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got.collect())


def test_suffix_empty(spark):
    assert suffix_dedup.remove_repeats(table(spark, [])).count() == 0
    assert [tuple(r)[:4] for r in suffix_dedup.remove_repeats(table(spark, [(1, None)])).collect()] == [(1, 0, 0, 0)]


def test_loser_tree_orders_and_knows_prefixes():
    rng = random.Random(5)
    for k in (1, 2, 3, 7):
        runs = []
        for _ in range(k):
            strings = sorted(bytes(rng.choice(b"ab") for _ in range(6)) for _ in range(rng.randint(0, 30)))
            lcp = [0] + [next((i for i in range(6) if a[i] != b[i]), 6) for a, b in zip(strings, strings[1:])]
            runs.append((strings, lcp[: len(strings)]))
        out = [(runs[r][0][i], n) for r, i, n in suffix_dedup.merged(runs)]
        assert [s for s, _ in out] == sorted(s for r in runs for s in r[0])
        for (a, _), (b, n) in zip(out, out[1:]):
            assert n == next((i for i in range(6) if a[i] != b[i]), 6)
