import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from wordloom.llm import html_extract as H
from wordloom.llm import token_counts as TC
from wordloom.llm import token_output as TO
from wordloom.llm.tokenizer import TextEncoder

TOK = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "<p>no</p>";</script></head>
<body><div class="site-header"><a href="/">Home</a></div><nav><ul><li><a href=x>One</a><li>Two</ul></nav>
<div class="cookie-notice"><p>We use cookies, as everyone does, and more, and more.</p></div>
<!-- <p>hidden</p> --><div class="content"><h2>Head &amp; line</h2><div class="text">
<p>First  paragraph,\n long enough, with commas; and &lt;b&gt; it <b>goes</b> on &#233;.<p>Second para<i>graph</i> is fine.
<ul><li>item a<li>item b</ul><table><tr><td>x<td>y</table><p>Ok.<br>Bye.</div></div>
<aside><p>Side, text, with, many, commas, here, and there, again, more text than ever.</p></aside>
<div class="ads"><p>Buy, buy, buy, now.</p></div><form><p>Your mail</p><input><textarea>x</textarea></form>
<section id="comments"><p>Nice article, thanks, I liked it, very much, indeed.</p></section><footer>&copy; me</footer>"""
TEXT = ("Head & line\nFirst paragraph, long enough, with commas; and <b> it goes on é.\nSecond paragraph is fine.\n"
        "item a\nitem b\nx\ny\nOk. Bye.")


def test_page_text():
    assert H.extract(PAGE) == TEXT
    assert H.extract(PAGE.replace('class="content"', "").replace('<div class="text">', "<article>")).startswith("First")
    assert [H.extract(x) for x in (None, "", "  ", "<p></p>", "<script>a</script>", "plain", "<p>a<p>b")] == [
        "", "", "", "", "", "plain", "a\nb"]
    assert H.extract("<article><h1>T</h1><p>One.</p></article><p>x</p><artic") == "T\nOne."


def test_page_parts_known_by_name():
    long = "A sentence, with commas, and words. " * 6
    page = ("<body class='has-sidebar'><div class='wrap with-sidebar'><div class='post-header'><h1>Title</h1></div>"
            f"<div class='post-body'><p>{long}</p><p>Short.</p><ol class='commentlist'><li>Me too, and more.</li></ol>"
            "<div class='alert'>Closed.</div><p class='commentary'>Kept.</p></div></div>"
            "<ins class='adsbygoogle'>Buy</ins><div role='navigation'><a>x</a></div><div hidden>no</div>"
            "<div style='display: none'>no</div><div id='page_footer'>me</div></body>")
    assert H.extract(page) == f"Title\n{long.strip()}\nShort.\nKept."
    loose = f"<body><p><a href=/>Home</a> <a href=/b>About us</a></p><p>{long}</p><p>End.</p></body>"
    assert H.extract(loose) == f"{long.strip()}\nEnd."


def test_page_text_after_inline_away_parts():
    skip = "<body><a class='skip-link' href='#c'>Skip</a><article><h1>T</h1><p>One, two.</p></article></body>"
    assert H.extract(skip) == "T\nOne, two."
    icon = "<article><h1><i class='icon' aria-hidden='true'></i> Title</h1><p>Text, more.</p></article>"
    assert H.extract(icon) == "Title\nText, more."
    for tag in ("span", "a", "ins", "b", "em", "label"):
        assert H.extract(f"<article><p>one <{tag} class='ad'>x</{tag}> two</p></article>") == "one two"
    nested = "<article><p>one <span class='ad'>x <span>y <b>z</span> w</span> two</p><p>Three.</p></article>"
    assert H.extract(nested) == "one two\nThree."
    # An inline element that is not closed ends with its block.
    assert H.extract("<article><p>one <span class='ad'>x</p><p>Two.</span></p></article>") == "one\nTwo."


def test_page_names_lower_a_score_and_do_not_delete():
    long = "A sentence, with commas, and words. " * 6
    para = f"<p>{long}</p>"
    text = long.strip()
    # Wrappers of the article, by an article element or by most of the text.
    for page in (f"<div class='content-sidebar-wrap'><main>{para}</main></div>",
                 f"<div id='content' class='sidebar-right'>{para}</div>",
                 f"<div class='social widget'><div class='sidebar'><article>{para}</article></div></div>",
                 f"<div class='ad-free'>{para}</div><div class='ad'>Buy, now.</div>",
                 f"<form id='aspnetForm'><div>{para}</div></form>",
                 f"<span class='banner'>{para}</span>"):
        assert H.extract(f"<body>{page}</body>") == text
    # Parts of the article with a common word in their name.
    for part, want in (("<section id='related-work'><h2>Related work</h2>" + para + "<p>Ok.</p></section>",
                        f"Related work\n{text}\nOk."),
                       ("<h2 id='recommendations'>Advice</h2>" + para, f"Advice\n{text}"),
                       ("<p class='share-price'>It rose.</p>", "It rose."),
                       ("<p>It <b id='share'>rose</b> <span class='social-policy'>fast</span>.</p>", "It rose fast.")):
        for tag in ("article", "div"):
            assert H.extract(f"<body><{tag}>{para * 2}{part}</{tag}></body>") == f"{text}\n{text}\n{want}"
    # Names still tell what is beside the article, however long the comments are.
    for part in ("<div class='related'><a href=/>More</a></div>", "<div class='share-buttons'>Share</div>",
                 f"<div id='comments'>{para * 5}</div>", "<p class='copyright'>Me.</p>",
                 f"<div class='widget'><p>{long[:36]}</p></div>", f"<div style='display:none'>{para * 5}</div>"):
        assert H.extract(f"<body><article>{para * 2}</article>{part}</body>") == f"{text}\n{text}"


def test_page_content_outside_the_container():
    long = "A sentence, with commas, and words. " * 6
    para, text = f"<p>{long}</p>", long.strip()
    lead = f"<h1>Title</h1><h2>Below</h2><div>{para * 3}</div>"
    assert H.extract(f"<body>{lead}</body>") == "\n".join(["Title", "Below", *[text] * 3])
    two = f"<section>{para * 6}</section><section><h2>More</h2>{para}<ul><li>item</ul></section>"
    assert H.extract(f"<body>{two}</body>") == "\n".join([text] * 6 + ["More", text, "item"])
    for tag in ("main", "body"):
        page = f"<{tag}><h1>Title</h1><article>{para * 2}</article></{tag}>"
        assert H.extract(page) == f"Title\n{text}\n{text}"
    assert H.extract(f"<main><h2>Title</h2><article>{para}</article></main>") == f"Title\n{text}"
    split = f"<body><article>{para * 9}</article><div><h1>End</h1>{para}</div><p>x</p></body>"
    assert H.extract(split) == "\n".join([text] * 9 + ["End", text])


def test_pages_of_the_table(sf_tables):
    import html
    import re
    got = sf_tables.query("op7_html_extraction").collect()
    pages = dict(sf_tables.con.execute("SELECT page_id, html FROM pages").fetchall())
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        body = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1)>", "\n", body.replace("<br>", " ")))
        lines = (re.sub(r"\s+", " ", html.unescape(x)).strip() for x in body.split("\n"))
        assert r.text == "\n".join(x for x in lines if x) and r.n_chars == len(r.text)


def test_pages_edges(spark):
    rows = [(1, None, "x", None), (1, None, "x", None), (None, "<p>" + "word, " * 60000, "y", 3)]
    got = H.extract_pages(spark.createDataFrame(rows, "page_id long, html string, text string, n_chars long")).collect()
    assert sorted((r.n_chars, str(r.page_id)) for r in got) == [(0, "1"), (0, "1"), (359999, "None")]
    assert H.extract_pages(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_encoder_equals_the_library():
    enc, rng = TextEncoder(memory_bytes=20_000), random.Random(1)
    guarded = TextEncoder(guard_control=True)
    bits = [" ", "  ", "\n", "a", "é", "I'm", "123", "…", "中", " ", "　", "\x1c", "'s", ".", "\t", "Ġ", "😀", "ab, cd", "<|endoftext|>", "x" * 80, "end."]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + [None]
    for t, got in zip(texts, enc.encode(texts)):
        assert np.frombuffer(got, enc.type).tolist() == TOK.encode(t or "", add_special_tokens=False).ids
        assert guarded.control is None and 50256 not in np.frombuffer(guarded.encode_one(t), enc.type)
    assert len(enc.inner) < 100 and all(len(p) <= 64 for p in enc.inner)      # bounded in bytes, no long part


def test_too_many_ids_are_an_error(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(TO, "MAX_VOCAB", 1000)
    with pytest.raises(ValueError, match="at most 1000"):
        TO.write_token_files(spark.createDataFrame([(1, "a")], "doc_id long, text string"), f"{tmp_path}/t")
    assert not (tmp_path / "t").exists()


def test_slices_are_bounded_in_bytes():
    import pyarrow as pa
    from wordloom.llm.common import bounded
    texts = ["a" * n for n in (10, 500, 3000, 20, 0, 900)] + [None, "b"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], ["i", "t"])
    got = [s.column(1).to_pylist() for s in bounded([batch, batch.slice(0, 0)], 1, 1000)]
    assert sum(got, []) == texts and all(len(s) == 1 or sum(len(t or "") for t in s) <= 1000 for s in got)


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_codes_round_trip(n):
    rng = np.random.default_rng(n)
    ranks = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype("<u4")
    control, data = TO.pack_ranks(ranks)
    assert len(control) == -(-n // 4) and np.array_equal(TO.unpack_ranks(control, data, n), ranks)


def expected(rows):
    start, out = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = TOK.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(TO, "BLOCK_IDS", 40)
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["tok", "en", "é", "\n"]) for _ in range(rng.randint(0, 40)))) for i in range(200)]
    rows += [(900, None), (901, ""), (902, "long " * 30000), (None, "first"), (77, rows[77][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    TO.write_token_files(df, f"{tmp_path}/t")
    got = sorted(TO.token_index(spark, f"{tmp_path}/t").collect(), key=lambda r: r.start)
    assert [tuple(r) for r in got] == expected(rows)
    TO.write_token_files(df.limit(0), f"{tmp_path}/e")
    assert TO.token_index(spark, f"{tmp_path}/e").count() == 0


def test_counts_equal_brute_force(spark, sf_tables):
    rng = np.random.default_rng(0)
    n = np.append(rng.integers(0, 9000, 500), [0, 0, 5])
    hist = TC.length_histogram(spark.createDataFrame([(int(x),) for x in n], "n_tokens long"))
    sums = TC.suffix_sums(hist).cache()
    assert sorted(map(tuple, sums.collect())) == TC.brute_force(n)
    q = {r.q: r.n_tokens for r in TC.quantiles(spark, sums, [0.0, 0.5, 0.99, 1.0]).collect()}
    want = np.sort(n)
    assert q == {p: int(want[max(1, int(np.ceil(p * len(n)))) - 1]) for p in q}
    cut = TC.truncated_totals(hist, [7, 4097, 0]).collect()
    assert {r.context_limit: (r.kept_tokens, r.cut_docs) for r in cut} == {
        c: (int(np.minimum(n, c).sum()), int((n > c).sum())) for c in (7, 4097, 0)}
    assert TC.suffix_sums(hist.limit(0)).count() == 0
    got = sf_tables.query("op3_token_counts").collect()
    texts = [t for t, in sf_tables.con.execute("SELECT text FROM documents").fetchall()]
    lens = np.array([len(TOK.encode(t or "", add_special_tokens=False).ids) for t in texts])
    assert sorted(map(tuple, got)) == TC.brute_force(lens)
    docs = spark.createDataFrame([(None,), ("",), ("a b",), ("a b",)], "text string")
    assert sorted(r.n_tokens for r in TC.encoded_lengths(docs).collect()) == [0, 0, 2, 2]


def test_token_output_of_the_table(sf_tables):
    got = sorted(map(tuple, sf_tables.query("op9_token_output").collect()), key=lambda r: r[1])
    assert got == expected(sf_tables.con.execute("SELECT doc_id, text FROM documents").fetchall())


def test_comments_cells_and_formulas_of_an_article():
    long = ("The river rose again last night, and the people of the valley, who had seen it before, moved their "
            "things upstairs. By the morning it was calm; nobody was hurt, and the road was open.")
    more = [long.replace("river", w) for w in ("lake", "sea", "pond", "brook", "well")]

    def p(texts):
        return "".join(f"<p>{x}</p>" for x in texts)
    # Reader comments that are most of the article element still are comments.
    assert H.extract(f"<article><p>{long}</p><div class='comments'>{p(more)}</div></article>") == long
    assert H.extract(f"<article>{long}<div class='comments'>{''.join(more)}</div></article>") == long
    assert H.extract(f"<div><p>{long}</p></div><div class='comments'>{p(more)}</div>") == long
    # Marks around all of the text say nothing.
    assert H.extract(f"<body><form>{p(more)}</form></body>") == "\n".join(more)
    assert H.extract(f"<article><div class='comments-open'>{p(more)}</div></article>") == "\n".join(more)
    # A layout's cell of short text beside the article's cell; a table inside an article stays.
    assert H.extract(f"<table><tr><td>m1 m2</td><td>{p([long, more[0]])}</td></tr></table>") == f"{long}\n{more[0]}"
    kept = f"<h1>T</h1><p>{long}</p><table><tr><td>a</td><td>b 1</td></tr></table><p>{more[0]}</p>"
    assert H.extract(f"<body>{kept}</body>") == f"T\n{long}\na\nb 1\n{more[0]}"
    # Formulas are words of their paragraph.
    assert H.extract(f"<article><p>We have <math><mi>x</mi><mo>=</mo><mn>2</mn></math> here. {long}</p></article>") \
        == f"We have x=2 here. {long}"
