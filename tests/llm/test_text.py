"""Language, quality, WARC, HTML, mixing, lines and packing against plain versions."""

import gzip
import math
import random
import re
import time
import zlib

import pytest

from reachlens.llm import html_text, language, mixing, packing, quality, queries, site_lines, warc
from pyspark.sql import functions as F

from tests.llm import plain_html

DOCS = "doc_id long, text string, lang string, source string, size long, target double, `row` int, stratum string, copies int"
PAGES = "page_id long, url string, html string, lang string, id int, payload string, last string"


def docs(spark, rows):
    """rows: (doc_id, text, lang, source); further columns clash with the operators' own."""
    return spark.createDataFrame([(*r, 1, 2.0, 3, "x", 4) for r in rows], DOCS)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "xx", 1, "p", "l") for r in rows], PAGES)


# quality

def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i:i + 3]), []).append(i)
    hit = {i + d for x in at.values() if len(x) > 1 for i in x for d in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_measures(spark):
    texts = [None, "", " \n ", "a", "a b", "a b c", "a b c a b c", "a a a a", "x y z w x y z\nx y z w\nx y z w\n\n#|<é>", "w " * 30_000, "line\nline\nline \nother", "a b c a b c d e a b c a"]
    rows = docs(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = {r.doc_id: tuple(r)[1:] for r in quality.with_measures(rows, F.col("text")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    assert got == {i: plain_measures(t) for i, t in enumerate(texts)}


def test_allowed_is_the_exact_binomial_bound(spark):
    ns = [0, 1, 50, 300, 1000, 5000]
    got = {r.good: r.allowed for r in quality.allowed(spark.createDataFrame([(n,) for n in ns], "good long"), 0.01, 0.001).collect()}
    for n in ns:
        p, best = 0.0, -1
        for k in range(n + 1):
            p += math.comb(n, k) * 0.01 ** k * 0.99 ** (n - k)
            if p > 0.001:
                break
            best = k
        assert got[n] == best


def test_judge_keeps_good_and_bounds_false_rejections(spark):
    rng = random.Random(1)
    good = lambda: " ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(2, 8))) for _ in range(60))
    rows = [(i, good(), "en", "s") for i in range(900)] + [(1000 + i, good().replace(" ", "### "), "en", "s") for i in range(100)]
    rows += [(3000, good().replace(" ", "### "), None, "s"), (3001, None, "en", "s"), (3001, None, "en", "s"), (3002, good().replace(" ", "### "), "zz", "s")]
    labels = spark.createDataFrame([(i, 1 if i < 1000 else 0) for i, *_ in rows if i < 3000] + [(None, 1), (1, None), (9999, 0)], "doc_id long, quality int")
    # one stratum with enough labels
    out = {r.doc_id: r for r in quality.judge(docs(spark, rows), labels, risk=0.25).collect()}
    assert sum(not out[i].kept for i in range(900)) <= 0.25 * 900
    assert all(out[i].kept for i in range(900)) and not any(out[1000 + i].kept for i in range(100))
    assert out[3000].kept and out[3002].kept and not out[3001].kept and out[3001].base_failed
    kept = quality.keep_good(docs(spark, rows), labels, risk=0.25)
    assert kept.columns == docs(spark, []).columns and {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if r.kept}
    # too few labels certify nothing
    few = quality.judge(docs(spark, rows), labels.filter("doc_id < 30")).collect()
    assert all(r.kept == (not r.base_failed) for r in few)
    assert quality.judge(docs(spark, []), labels).count() == 0


def test_repeated_labels_prove_nothing_more(spark):
    rng = random.Random(2)
    good = lambda: " ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(2, 8))) for _ in range(60))
    rows = [(i, good(), "en", "s") for i in range(30)] + [(100 + i, good().replace(" ", "### "), "en", "s") for i in range(10)]
    once = [(i, int(i < 100)) for i, *_ in rows]
    for labels in (once, once * 40, once * 40 + [(i, 0) for i in range(30)]):
        out = quality.judge(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert all(r.kept for r in out)
    # nor do repeated documents
    out = quality.judge(docs(spark, rows * 40), spark.createDataFrame(once, "doc_id long, quality int")).collect()
    assert len(out) == 1600 and all(r.kept for r in out)


def test_many_strata(spark):
    text = "word " * 60
    rows = [(i, text + str(i), f"l{i}", "s") for i in range(2100)] + [(5000, text, None, "s")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(2100)], "doc_id long, quality int")
    assert quality.judge(docs(spark, rows), labels).count() == 2101
    assert quality.keep_good(docs(spark, rows), labels).count() == quality.judge(docs(spark, rows), labels).filter("kept").count()


# mixing

def plain_targets(sizes):
    total = sum(sizes.values())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped = set()
    while True:
        rest = [s for s in names if s not in capped]
        free = total - sum(3 * sizes[s] for s in capped)
        unit = free / sum(weight[s] for s in rest) if rest else 0
        over = {s for s in rest if unit * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else unit * weight[s] for s in names}
        capped |= over


def test_mix(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 40), "en", rng.choice(["a", "a", "a", "b", "é", "z", None, "tiny"] if i % 50 else ["tiny"])) for i in range(800)]
    rows += [(5000, None, "en", "empty"), (None, "x y", "en", "b"), (7, "q q q", "en", "a"), (7, "q q q", "en", "a")]
    frame = docs(spark, rows)
    got = mixing.mix_table(frame).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.mix_table(frame.repartition(5)).collect()))
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets = plain_targets(sizes)
    by_target = {}
    for r in got:
        assert r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
        by_target.setdefault((r.source_size, round(r.target, 6)), []).append(r.taken)
    for s, n in sizes.items():
        assert abs(sum(by_target[(n, round(targets[s], 6))]) - targets[s]) <= 45
    mix = mixing.mixed_documents(frame)
    assert mix.columns == frame.columns
    assert sorted(str(r.doc_id) for r in mix.collect()) == sorted(str(r.doc_id) for r in got for _ in range(r.taken // r.size if r.size else 0))
    assert mixing.mix_table(docs(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix_table(docs(spark, [(1, None, "en", None)])).collect()] == [0]


# packing

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_pack(spark, tokenizer):
    texts = [None, "", "Hello, WORLD's end\tx\n\ny <|endoftext|> <|startoftext|>", "é ́a ÀÉ ﬁ 12 don't''s", "日本 語 \x85 \x1c z", "word " * 5000, "abc " * 2047, "q" * 9000]
    texts += [" ".join(random.Random(i).choices(["the", "of", "thntblere", "é!"], k=random.Random(i).randint(1, 900))) for i in range(200)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, "null id", "en", "s"), (3, texts[3], "en", "s")]
    out = packing.pack_documents(docs(spark, rows), queries.tokenizer_path(), with_ids=True)
    got = out.collect()
    want = []
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = b"".join(x.to_bytes(4, "little") for x in ids[k:k + 2048])
            want.append((i, k // 2048, k, len(part) // 4, zlib.crc32(part), part))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got), key=str) == sorted(want, key=str)
    at = {}
    for r in got:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(at) <= math.ceil(sum(r.length for r in got) / 2048) + 1
    sequences = {r.sequence_id: r.ids for r in packing.sequences(out).collect()}
    assert all(len(sequences[s]) == 4 * sum(n for _, n in p) for s, p in at.items())
    assert packing.pack_documents(docs(spark, []), queries.tokenizer_path()).count() == 0


def test_words_have_the_ids_of_whole_texts(tokenizer):
    """Stems and closing signs are remembered apart; texts join them again."""
    known = packing.WordIds(queries.tokenizer_path())
    odd = ["<|ENDOFTEXT|>", "x,<|endoftext|>.", "<|endoftext|>!", "ΑΣ.", "İ!", "Ⅷ;", "①:", "a).", "don't.", "'s,", "IT'S!?", "...", "ß&&&", "e\u0301.", "\u0301.", "٣!", "日本,", "A.b.", "x\t.y.", "क़!", "ﬁ.", "ſ;", "\u2028.", "K\u212a."]
    rng = random.Random(5)
    signs = "aZé'.,!&$<|>)9\u0301 ß"
    texts = odd + [" ".join(odd)] + ["".join(rng.choices(signs, k=rng.randint(1, 12))) for _ in range(3000)]
    for low in range(0, len(texts), 500):
        parts = [t.replace("\n", " ").split(" ") for t in texts[low:low + 500]]
        known.learn(parts)
        for t, p in zip(texts[low:low + 500], parts, strict=True):
            want = tokenizer.encode(t, add_special_tokens=False).ids
            assert known.encode(p) == b"".join(x.to_bytes(4, "little") for x in want), t


def test_fullest_is_the_best_sum():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(6)}
        room = rng.randint(0, 60)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * j for s in sums for j in range(n + 1) if s + k * j <= room}
        use = packing.fullest(counts, room)
        assert sum(k * n for k, n in use.items()) == max(sums) and all(n <= counts[k] for k, n in use.items())


# WARC

def test_warc(spark, tmp_path):
    rows = [(1, "http://a/", "<p>é\r\n\r\nWARC/1.1\r\n</p>"), (2, "http://b/ x\ny", "same"), (9, None, "same"), (5, "u", "same"), (3, "u", None), (4, "u", ""), (6, "u", "one"), (6, "u", "one"), (None, "u", "lone"), (7, "u", "x" * 300_000)]
    got = sorted((tuple(r) for r in warc.round_trip(pages(spark, rows), str(tmp_path / "w")).collect()), key=str)
    same = [x for x in rows if x[2] == "same"]
    want = []
    for i, _, t in rows:
        raw = (t or "").encode()
        last = {"same": 9, None: 4, "": 4}.get(t)
        revisit = last is not None and i != last
        want.append((i, len(raw), warc.sha1_digest(raw), "revisit" if revisit else "response", last if revisit else None))
    assert len(same) == 3 and got == sorted(want, key=str)
    found = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert not any(r.gap for r in found) and {bytes(r.payload) for r in found if r.type == "response"} == {(t or "").encode() for _, _, t in rows}
    assert warc.round_trip(pages(spark, []), str(tmp_path / "e")).count() == 0


def test_warc_of_dotted_columns(spark):
    rows = spark.createDataFrame([(1, "http://a.example/", "x", 3), (2, None, None, 4)], "page_id long, url string, html string, `a.b` int")
    assert sorted((r.page_id, r.payload_bytes) for r in warc.round_trip(rows).collect()) == [(1, 1), (2, 0)]


def test_warc_long_url(spark, tmp_path):
    """A response whose url is longer than any header bound keeps its row and those of its revisits."""
    rows = [(9, "data:" + "u" * 200_000, "same")] + [(i, "u", "same") for i in range(5)]
    got = sorted(tuple(r) for r in warc.round_trip(pages(spark, rows), str(tmp_path / "w")).collect())
    assert got == [(i, 4, warc.sha1_digest(b"same"), "response" if i == 9 else "revisit", None if i == 9 else 9) for i in (0, 1, 2, 3, 4, 9)]
    assert {r.url for r in warc.read_warc(spark, str(tmp_path / "w")).collect()} == {"data:" + "u" * 200_000, "u"}


def test_salvage_long_header():
    """Long headers are read after damage too; an unended one is a gap."""
    long = record(1).replace(b"Content-Length", b"X: " + b"x" * 100_000 + b"\r\nContent-Length")
    assert [bool(h) for *_, h, _ in warc.salvage(record(0)[:-5] + long + record(2))] == [False, True, True]
    assert [bool(h) for *_, h, _ in warc.salvage(b"WARC/1.1\r\nX: x")] == [False]


def record(n, body=b"hello", digest=True):
    block = body + str(n).encode()
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{n}>\r\nContent-Length: {len(block)}\r\n".encode()
    if digest:
        head += f"WARC-Block-Digest: sha1:{warc.sha1_digest(block)}\r\n".encode()
    return head + b"\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("pack", [lambda x: x, gzip.compress], ids=["plain", "gzip"])
def test_salvage(pack):
    parts = [pack(record(n, b"payload %d " % n * 50)) for n in range(6)]
    damaged = list(parts)
    middle = bytearray(parts[2])
    middle[len(middle) // 2] ^= 0x55
    damaged[2] = bytes(middle)
    damaged[4] = parts[4][: len(parts[4]) // 2]
    data = b"junk" + b"".join(damaged) + pack(record(9))[:-30]
    out = list(warc.salvage(data))
    assert [h["warc-record-id"] for _, _, h, _ in out if h] == [f"<urn:page:{n}>" for n in (0, 1, 3, 5)]
    assert [(s, e) for s, e, *_ in out][0] == (0, 4) and out[0][2] is None
    assert all(a[1] == b[0] for a, b in zip(out, out[1:])) and out[-1][1] == len(data) and out[-1][2] is None
    assert sum(h is None for _, _, h, _ in out) == 4


def test_salvage_wrong_length():
    wrong = record(1, digest=False).replace(b"Content-Length: 6", b"Content-Length: 99")
    assert [bool(h) for *_, h, _ in warc.salvage(wrong + record(2))] == [False, True]
    assert list(warc.salvage(b"")) == []


def test_salvage_files(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"xx" + record(1) + record(2))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record(3)) + b"\x1f\x8b\x08broken" + gzip.compress(record(4)))
    out = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted(r.record_id for r in out if not r.gap) == [f"<urn:page:{n}>" for n in (1, 2, 3, 4)]
    assert sorted((r.start, r.end - r.start) for r in out if r.gap)[0] == (0, 2) and sum(r.gap for r in out) == 2


# HTML

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/x">X</a></ul></nav><!-- c -->
<div class="cookie-notice">We use cookies, many of them, and more text than one would think, really, a lot of it.</div>
<div id="wrap"><article><h1>Title &amp; more</h1><p>First&nbsp;paragraph, with <a href="x">a link</a>, and   enough
text to score, of course.<p><b>Second one, unclosed, with commas, and words that go on for a while.<br>next line
<ul><li>item one, which is long enough to read as text<li>item two</ul><ul><li><a href=1>related one</a><li><a href=2>related two</a></ul>
<form><input name=a>Search here</form><div class=ad>Buy this now, please, it is great, really.</div></article>
<section id="comments"><p>A reader says, at length, with commas, that this is a long comment, which goes on and on and on.</p></section></div>
<aside>Side, bar, text</aside><footer>&copy; foot</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE).split("\n\n") == [
        "Title & more", "First paragraph, with a link, and enough text to score, of course.",
        "Second one, unclosed, with commas, and words that go on for a while. next line", "item one, which is long enough to read as text", "item two"]


PARAGRAPHS = [f"Paragraph {k} of the article, with commas, goes on long enough to be taken for text, as one would think." for k in range(6)]
BODY = "".join(f"<p>{x}</p>" for x in PARAGRAPHS)
AROUND = '<div class="sidebar"><p>Side text, which is long enough to score, too.</p></div>', '<div class="footer">Foot text, long enough to score, with a comma.</div>'


@pytest.mark.parametrize("start, end", [
    ('<div id="content" class="no-sidebar">', "</div>"), ('<div class="layout with-header">', "</div>"), ('<div class="post hentry tag-social category-newsletter">', "</div>"),
    ('<div class="layout with-header"><div class="has-menu">', "</div></div>"), ("<form action=x><div>", "</div></form>"), ('<form id="aspnetForm"><article>', "</article></form>"),
    ('<form role="form"><div class="modal-page"><div>', "</div></div></form>")])
def test_names_do_not_lose_the_article(start, end):
    """Names and forms around the article are outweighed by its text; what is beside it goes as before."""
    for page in (start + BODY + end, AROUND[0] + start + BODY + end + AROUND[1], start + AROUND[0] + BODY + AROUND[1] + end):
        assert html_text.main_text(f"<html><body>{page}</body></html>").split("\n\n") == PARAGRAPHS


def test_names_still_leave_out():
    comments = '<div id="comments">' + "".join(f'<div class="comment"><p>{x}</p></div>' for x in PARAGRAPHS * 3) + "</div>"
    post = "".join(f"<p>{x}</p>" for x in PARAGRAPHS[:2])
    for name in ("<article>", '<div class="post">', '<div class="post tag-social">'):
        tag = name[1:].split(">")[0].split(" ")[0]
        form = "<form><p>Search here, or there, or anywhere at all in this place.</p></form>"
        assert html_text.main_text(f"<body>{name}{post}{form}</{tag}>{comments}</body>").split("\n\n") == PARAGRAPHS[:2], name


def test_named_side_stays_out():
    """A side column that is also called content does not come along with the article."""
    side = '<div class="content sidebar"><p>Side text, which is long enough to score, too.</p></div>'
    assert html_text.main_text(f"<body><div><article>{BODY}</article>{side}</div></body>").split("\n\n") == PARAGRAPHS


def test_each_named_post_stays():
    """Posts of an index page are kept for being called posts, though none holds most of the text."""
    posts = "".join(f'<div class="post hentry tag-social"><div><p>{x}</p></div></div>' for x in [", ".join(PARAGRAPHS[:3])] * 3)
    assert html_text.main_text(f"<body><div>{posts}</div></body>").count("Paragraph 2") == 3


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<script>", "<!--", "</p></p>", "<a><a><b>", "<table><tr><td>" * 500, "<div>" * 3000 + "x", "\x00<p>\x00", '<p class="a>x</p>'])
def test_odd_pages(page):
    assert isinstance(html_text.main_text(page), str)


def test_text_without_markup():
    assert html_text.main_text("only text") == "only text"
    assert html_text.main_text("<p>short</p>") == "short"


def test_extract(spark):
    rows = [(1, "u", PAGE), (2, None, None), (None, "u", "<p>é one</p>"), (1, "u", PAGE)]
    got = html_text.extract(pages(spark, rows)).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got) == sorted([("1", len(html_text.main_text(PAGE)))] * 2 + [("2", 0), ("None", 5)])
    assert html_text.extract(pages(spark, [])).count() == 0


# lines

def _shape(parsed):
    nodes, blocks = parsed
    at = {id(n): i for i, n in enumerate(nodes)}
    return [(n.tag, n.links, n.out, n.doubt, n.named, at.get(id(n.parent))) for n in nodes], [(at[id(n)], t, k) for n, t, k in blocks]


def test_parsing_equals_plain_scans_of_the_stack():
    rng = random.Random(7)
    tags = "html body div p span a b i li ul ol td tr table th dt dd dl h1 h2 header article main section form br img option select script".split()
    for _ in range(3000):
        page = "".join(f"<{t}>" if r < 0.45 else f"</{t}>" if r < 0.75 else rng.choice(
            ["text, here ", "x", "<!-- c -->", "<", "a > b", "<a href='x>y'>", "<!-- open", '<p class="ad">', "<b/>", "<div/>", "&amp;", "<a b", '<a "'])
            for t, r in ((rng.choice(tags), rng.random()) for _ in range(rng.randint(1, 25))))
        assert _shape(html_text.parse(page)) == _shape(plain_html.parse(page)), page


@pytest.mark.parametrize("mark", ['<a "', "<font><div>..", "<span><a href=x>y</a>", "<a b ", '<a ">" ', "<a<a", '<a  ="', "<b><p>x</p>", "<form><li>x"])
def test_broken_pages_take_linear_time(mark):
    """A megabyte of each; the bound is loose, as quadratic time would be half an hour."""
    start = time.process_time()
    html_text.main_text(mark * (2 ** 20 // len(mark)))
    html_text.main_text("<b>" * 2 ** 16 + mark * 2 ** 12 + "</i>" * 2 ** 16 + ">")
    assert time.process_time() - start < 20


def test_site_lines(spark):
    rows = [(i, f"http://A.example/{i}", f"<p>page {i}</p><footer>foot</footer>") for i in range(20)]
    rows += [(100 + i, f"http://b.example/{i}", f"<p>foot</p><p>b {i}</p>" if i == 0 else f"<p>b {i}</p><p>b {i}</p>") for i in range(30)]
    rows += [(200, "http://few.example/", "<p>foot</p>"), (201, None, None), (None, "nonsense", "<p>x</p>")]
    got = {r.page_id: r for r in site_lines.drop_site_boilerplate(pages(spark, rows), site_lines.html_lines(F.col("html")), site_lines.host(F.col("url"))).collect()}
    assert all(got[i].text == f"page {i}" and got[i].n_dropped == 1 and got[i].site == "a.example" for i in range(20))
    assert got[100].text == "foot\nb 0" and got[101].text == "b 1\nb 1" and got[200].text == "foot"
    assert (got[201].n_lines, got[201].text) == (0, "") and got[None].text == "x"
    assert site_lines.drop_site_boilerplate(pages(spark, []), site_lines.html_lines(F.col("html")), site_lines.host(F.col("url"))).count() == 0


def test_site_lines_of_small_hosts(spark):
    """The ratio holds on hosts of every size; a line on one or two pages stays."""
    sizes = (1, 2, 3, 9, 10, 40)
    rows = [(1000 * n + i, f"http://h{n}.example/{i}", f"<p>all</p><p>{'two' if i < 2 else 'x'}</p><p>{'three' if i < 3 else 'y'}</p><p>own {i}</p>") for n in sizes for i in range(n)]
    got = {r.page_id: r.text.split("\n") for r in site_lines.drop_site_boilerplate(pages(spark, rows), site_lines.html_lines(F.col("html")), site_lines.host(F.col("url"))).collect()}
    for n in sizes:
        for i in range(n):
            lines = ["all", "two" if i < 2 else "x", "three" if i < 3 else "y", f"own {i}"]
            count = {"all": n, "two": min(n, 2), "x": n - 2, "three": min(n, 3), "y": n - 3}
            assert got[1000 * n + i] == [x for x in lines if count.get(x, 1) < 3 or count.get(x, 1) <= 0.1 * n], (n, i)


# language

def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    every = spark.read.parquet(f"{sf}/documents.parquet")
    languages, model = language.train(every.filter("doc_id % 2 = 0"))
    held = language.text_scores(every.filter("doc_id % 2 = 1"), model, "text", False)
    best = F.get(F.array(*map(F.lit, languages)), (F.array_position("scores", F.array_max("scores")) - 1).cast("int"))
    right, n = held.agg(F.sum((best == F.col("lang")).cast("int")), F.count("*")).first()
    assert right >= 0.97 * n
    got = language.identify(spark.read.parquet(f"{sf}/pages.parquet"), languages, model)
    right, n = got.agg(F.sum((F.regexp_extract("url", "/(en|de|fr|es)/", 1) == F.col("lang")).cast("int")), F.count("*")).first()
    assert right >= 0.97 * n


def test_language_evidence(spark):
    """Without text, the host, the declared tag and the suffix decide."""
    train = docs(spark, [(i, ("the of and thing " if i % 2 else "der die und ein ") * 20, "en" if i % 2 else "de", "s") for i in range(40)] + [(99, None, "en", "s"), (98, "x", None, "s")])
    languages, model = language.train(train)
    assert languages == ["de", "en"]
    text = {"en": "the of and thing " * 10, "de": "der die und ein " * 10}
    rows = [(i, f"http://h{'de' if i % 2 else 'en'}.example.org/{i}", f"<html lang={'de' if i % 2 else 'en'}><p>{text['de' if i % 2 else 'en']}</p>") for i in range(60)]
    rows += [(100, "http://hde.example.org/x", "<p></p>"), (101, "http://hen.example.org/x", None), (102, "http://new.example.com/x", '<html lang="de-AT"></html>'), (None, None, None)]
    got = {r.page_id: r for r in language.identify(pages(spark, rows), languages, model).collect()}
    assert len(got) == 64 and all(got[i].lang == ("de" if i % 2 else "en") for i in range(60))
    assert (got[100].lang, got[101].lang, got[102].lang) == ("de", "en", "de") and got[100].text_lang is None and got[None].lang in languages
    assert all(0 < r.confidence <= 1 for r in got.values())
    assert language.identify(pages(spark, []), languages, model).count() == 0


def test_language_many_labels(spark):
    """Every labelled language is known, also beyond two hundred, and found again."""
    sign = lambda k: "".join(chr(97 + k // d % 6) for d in (1, 6, 36, 216))
    train = docs(spark, [(k, f"{sign(k)} " * 30, f"x{k:03}", "s") for k in range(230)] + [(999, "common", "x000", "s")] * 2)
    languages, model = language.train(train)
    assert languages == [f"x{k:03}" for k in range(230)] and model.shape[0] == 230
    got = {r.page_id: r for r in language.identify(pages(spark, [(k, f"http://h{k}.example/", f"<p>{sign(k)} {sign(k)} {sign(k)} {sign(k)}</p>") for k in (0, 7, 229)]), languages, model).collect()}
    assert all(got[k].text_lang == f"x{k:03}" for k in (0, 7, 229))


def test_word_memory_is_one_and_keeps_what_is_at_hand(monkeypatch):
    """Words and their parts share one memory; when it is full the words of the texts at hand stay, others are looked up anew."""
    known = packing.WordIds(queries.tokenizer_path())
    letters = [c for c in map(chr, range(0x250)) if packing.PLAIN(c)]
    blocks = [[["same", "Same,", f"word{k}x", letters[k % len(letters)] * 3 + letters[-k % len(letters)], f"Ärger{'abc'[k % 3]}!", ""]] for k in range(120)]
    monkeypatch.setattr(packing, "WORDS", 40)
    for block in blocks:
        known.learn(block)
        # at most the words at hand and their parts come on top
        assert len(known.ids) <= 40 + 3 * len(block[0])
        want = known.tokenizer.encode(" ".join(block[0]), add_special_tokens=False).ids
        assert known.encode(block[0]) == b"".join(x.to_bytes(4, "little") for x in want), block
    assert "word0x" not in known.ids and "same" in known.ids
