"""HTML extraction, fingerprints, token scans, URL templates and chat formatting."""

from __future__ import annotations

import html
import math
import random
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from mercadal.llm import chat, html_crf, iblt, separators, tokens, url_templates  # noqa: E402
from mercadal.llm.queries import QUERIES  # noqa: E402
from mercadal.llm.tables import show_package  # noqa: E402
from mercadal.session import local_table  # noqa: E402

SMALL = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


@pytest.fixture(autouse=True)
def package(spark):
    show_package(spark)


@pytest.fixture(scope="module")
def chain(spark):
    return html_crf.learn(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_blocks_of_broken_markup():
    def of(page):
        return [b.text for b in html_crf.blocks_of(page)]

    assert of("<p>a <b>b<br>c<p>d&amp;amp; &lt;i&gt;&nbsp;e") == ["a b c", "d&amp; <i> e"]
    assert of("<head><title>t</title></head>x<script>var a='<p>no</p>'</script>y<!-- z --><style>q") == ["x y"]
    assert of("<ul><li>a<li>b<ul><li>c</ul>d</ul>e</nope><td>f") == ["a", "b", "c", "d", "e", "f"]
    assert of("<a title='x>y' href=\"q>r\">link</a> <img alt=no>after < b") == ["link after < b"]
    assert of("") == of("<") [:0] == of("<!-- open") == of("<div") == []
    assert of("<div>" * 3000 + "deep" + "</div>" * 3000) == ["deep"]
    assert of("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]


def test_no_markup_hides_the_rest_of_a_page():
    def of(page):
        return [b.text for b in html_crf.blocks_of(page)]

    assert of("<p>one</p><svg class=i /><p>two</p>") == ["one", "two"]
    assert of("<p>one</p><svg a='x>y'/><p>two</p><svg><text>no</text></svg><p>three") == ["one", "two", "three"]
    assert of("<p>one</p><svg><path/></svg><p>two</p><SVG/>") == ["one", "two"]
    assert of("<p>one</p><title-card>q</title-card><select-x>r</select-x><p>two</p>") == ["one", "q", "r", "two"]
    assert of("<html><head><title>t</title><p>one</p><p>two</p>") == ["one", "two"]
    assert of("<head><meta a><link b><noscript><link c></noscript><base d>\n text <p>one</head><p>two") == ["text", "one", "two"]
    assert of("<head><header><p>one</p></header></head><p>two") == ["one", "two"]
    assert of("<p>sum <math><mi>x</mi><mo>+</mo><mn>1</mn></math> end <math/>too") == ["sum x+1 end too"]
    assert of("<p>a <noscript>plain <b>form</b></noscript> b <object data=x>fall back</object>") == ["a plain form b fall back"]
    assert of("<p>&<b>amp;</b> &amp;<b>lt;</b> &lt;<!-- -->x") == ["&amp; &lt; <x"]
    assert of("<script>a</scripted>b</script x>c<style>d</style >e") == ["c e"]
    assert of("<svg" * 3000) == of("<svg>" * 3000) == []


def test_viterbi_finds_the_best_chain():
    dice = random.Random(2)
    for _ in range(40):
        names = "abcde"
        chain = html_crf.Chain({n: dice.uniform(-2, 2) for n in names}, np.array([[dice.uniform(-1, 1) for _ in "xy"] for _ in "xy"]), dice.uniform(-1, 1))
        blocks = [html_crf.Block("t", frozenset(dice.sample(names, 2))) for _ in range(6)]

        def score(labels, chain=chain, blocks=blocks):
            s = chain.first * labels[0] + sum(chain.steps[a, b] for a, b in zip(labels, labels[1:], strict=False))
            return s + sum(chain.weights[n] for b, y in zip(blocks, labels, strict=True) if y for n in b.names)

        best = max(([k >> i & 1 for i in range(6)] for k in range(64)), key=score)
        assert score([int(x) for x in chain.decode(blocks)]) == pytest.approx(score(best))


def test_likelihood_gradient_matches_differences():
    dice = np.random.default_rng(0)
    there = np.array([[1, 1, 1.0], [1, 1, 0]])
    gain, move, first = dice.normal(size=(2, 3)) * there, dice.normal(size=(2, 2)), 0.3

    def log_total(gain, move, first):
        out = 0
        for g, n in zip(gain, (3, 2), strict=True):
            paths = [[k >> i & 1 for i in range(n)] for k in range(1 << n)]
            out += math.log(sum(math.exp(first * p[0] + sum(g[t] * p[t] for t in range(n)) + sum(move[p[t], p[t + 1]] for t in range(n - 1))) for p in paths))
        return out

    main, moves, start = html_crf.posterior(gain, move, first, there)
    e = 1e-5
    for i, t in [(0, 0), (0, 2), (1, 1)]:
        up = gain.copy()
        up[i, t] += e
        assert (log_total(up, move, first) - log_total(gain, move, first)) / e == pytest.approx(main[i, t], abs=1e-3)
    for a in (0, 1):
        for b in (0, 1):
            up = move.copy()
            up[a, b] += e
            assert (log_total(gain, up, first) - log_total(gain, move, first)) / e == pytest.approx(moves[a, b], abs=1e-3)
    assert (log_total(gain, move, first + e) - log_total(gain, move, first)) / e == pytest.approx(start, abs=1e-3)


def test_real_pages_give_their_article(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in QUERIES["op1_html_crf"](spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        inner = re.search(r"(?s)<article>(.*?)(?:</article>|<footer>|\Z)", p.html)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in re.split(r"</?(?:h1|p)>", inner)]
        assert got[p.page_id].text == "\n\n".join(x for x in blocks if x)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


def test_layouts_not_learned_from(chain):
    main = "The first paragraph tells a story of words, and it goes on for a while. It ends."
    pages = [
        f"<body><div class='site-menu'><a>Home</a> <a>News</a></div><div class=content-main><h1>Title words</h1><p>{main}</p><p>{main}</p></div><div class='right-sidebar'><p>{main}</p></div><div class='page-footer'>© all</div></body>",
        f"<main><h1>Title words</h1><p>{main}</p><div class=advert-box><p>{main}</p></div><p>{main}</p><section class='reader-comments'><p>{main}</p><p>{main}</p></section></main><footer><p>{main}</p></footer>",
        f"<header><p>{main}</p></header><article><h1>Title words</h1><p>{main}</p><form><p>{main}</p><input></form><p>{main}</p></article><aside><p>{main}</p></aside><div class=cookie-notice><p>{main}</p></div>",
    ]
    for page in pages:
        assert html_crf.main_text(chain, page) == f"Title words\n\n{main}\n\n{main}", page


def test_extraction_of_odd_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<p>only"), (3, "u", "<p>only"), (None, "u", "x" * 50000)]
    got = html_crf.extract(local_table(spark, rows, PAGES)).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got)[:1] in ([(0, 50000)], [(0, 0)])
    assert [r.text for r in got if r.page_id in (1, 2)] == ["", ""]
    assert len({r.text for r in got if r.page_id == 3}) == 1
    assert html_crf.extract(local_table(spark, [], PAGES)).count() == 0


def plain_items(text):
    return set(Counter(re.split(r"\n|(?<=[.!?])[ \t]+", text)).items())


def test_fingerprints_match_brute_force(spark):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    texts += [None, "", "", "One. Two. One.\nOne.", "x. " * 400, " ".join(f"S{i}." for i in range(900)), "é\U0001F600z" * 7]
    docs = brute.documents(spark, texts, [(None, "no id. at all.", "en", "s", 1)])
    got = sorted(iblt.fingerprints(docs.withColumn("hash", docs.lang)).collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0)))
    line = [(i, texts[i] or "") for i in range(len(texts) - 1, -1, -1)] + [(None, "no id. at all.")]
    assert [r.doc_id for r in got] == [i for i, _ in line]
    prints = defaultdict(set)
    for k, (r, (_, text)) in enumerate(zip(got, line, strict=True)):
        after = line[(k + 1) % len(line)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert (r.n_chars, r.edited_sha256) == (len(text), brute.sha(edited))

        def like(a, b):
            a, b = plain_items(a), plain_items(b)
            return 1 - len(a ^ b) / (len(a) + len(b))

        assert r.near_edited == pytest.approx(like(text, edited))
        assert r.near_next == pytest.approx(like(text, after))
        prints[text].add(r.fingerprint)
        prints[edited].add(r.edited_fingerprint)
    assert all(len(v) == 1 for v in prints.values())
    assert iblt.fingerprints(brute.documents(spark, [])).count() == 0


def test_repeated_rows_follow_alike(spark):
    rows = [(1, "a. b.", "en", "s", 1), (1, "a. b.", "en", "s", 1), (1, "c. d. e.", "en", "s", 1), (0, "f. g.", "en", "s", 1)]
    got = iblt.fingerprints(local_table(spark, rows, brute.DOCS)).collect()
    assert len(got) == 4
    assert len({r.edited_sha256 for r in got}) == 3


def test_peeling_recovers_small_differences(spark):
    from pyspark.sql import functions as F

    a, b = list(range(100)), [*range(3, 100), 500, 501]
    frame = local_table(spark, [(a, b)], "a array<bigint>, b array<bigint>")
    cells = iblt.long(16)
    p = iblt.peeled(iblt.subtracted(iblt.sketch(F.col("a"), cells), iblt.sketch(F.col("b"), cells)), cells)
    assert sorted(frame.select(p["found"].alias("f")).first().f) == [0, 1, 2, 500, 501]


def test_token_counts_match_the_encoder(spark):
    from tokenizers import Tokenizer

    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(50).collect()]
    texts += [None, "", "<|endoftext|> is text here", "", "a b c " * 3000]
    coder = Tokenizer.from_file(tokens.vocabulary_path())
    coder.encode_special_tokens = True
    docs = brute.documents(spark, texts, [(None, "x", "en", "s", 1)]).repartition(3)
    for block_ids in (64, 1 << 18):
        got = {r.doc_id: r.n_tokens for r in separators.token_counts(docs, block_ids).collect()}
        assert got.pop(None) == 1
        assert got == {i: len(coder.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert separators.token_counts(brute.documents(spark, [])).count() == 0


def test_scan_of_unfinished_files(spark):
    def ids(*values):
        return np.array(values, dtype="<u2").tobytes()

    rows = [(1, 0, ids(5, 9, 9, 5)), (1, 1, ids(5, 5)), (1, 2, ids()), (1, 3, ids(5, 9, 5)), (2, 0, ids(9)), (3, 0, ids(5, 5, 5))]
    got = separators.document_lengths(local_table(spark, rows, "file int, block long, ids binary"), end_id=9)
    want = [(1, 0, 1, True), (1, 1, 0, True), (1, 2, 4, True), (1, 3, 1, False), (2, 0, 0, True), (3, 0, 3, False)]
    assert sorted(map(tuple, got.collect())) == want


def brute_urls(urls, rules=url_templates.RULES):
    """Verdicts of the template tree over Python dictionaries."""
    rows = []
    for url in urls:
        host = path = ""
        if url and "://" in url:
            host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
            host = brute.lower_ascii(host)
        fit = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, None, None))
        segs = ["*" if re.search(r"^[0-9][0-9._-]*(\.[A-Za-z]+)?$|^(?=.*[0-9])[0-9a-fA-F-]{8,}$|^.{41,}$", s) else s for s in path.split("/") if s]
        rows.append((host, path, best[2], best[1], tuple(segs)))
    totals, template = {}, {}
    for own in (True, False):
        tree = lambda h, own=own: h if own else "*"
        at = {(h, s): () for h, _, _, _, s in rows}
        for level in range(max((len(r[4]) for r in rows), default=0)):
            stats = defaultdict(lambda: defaultdict(lambda: [0, 0]))
            for h, _, _, v, s in rows:
                if level < len(s):
                    c = stats[tree(h), at[h, s]][s[level]]
                    c[0] += v is not None
                    c[1] += v == "block"
            named = set()
            for node, kids in stats.items():
                n, b = (sum(k[i] for k in kids.values()) for i in (0, 1))
                for seg, (kn, kb) in kids.items():
                    if seg != "*" and kn and n > kn and 0 < b < n:
                        p = b / n
                        if abs(kb / kn - (b - kb) / (n - kn)) > 1.96 * math.sqrt(p * (1 - p) * (1 / kn + 1 / (n - kn))):
                            named.add((node, seg))
            for h, s in at:
                if level < len(s):
                    seg = s[level] if ((tree(h), at[h, s]), s[level]) in named else "*"
                    at[h, s] = (*at[h, s], seg)
        template[own] = at
        totals[own] = defaultdict(lambda: [0, 0])
        for h, _, _, v, s in rows:
            c = totals[own][tree(h), at[h, s]]
            c[0] += v is not None
            c[1] += v == "block"
    n, b = sum(r[3] is not None for r in rows), sum(r[3] == "block" for r in rows)
    out = []
    for host, path, rule, verdict, segs in rows:
        gn, gb = totals[False]["*", template[False][host, segs]]
        hn, hb = totals[True][host, template[True][host, segs]]
        purity = (hb + 4 * (gb + 4 * (b / n if n else 0)) / (gn + 4)) / (hn + 4)
        out.append((host, path, rule, verdict or ("block" if purity > 0.5 else "allow")))
    return out


def test_url_verdicts_match_brute_force(spark):
    urls = [r.url for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url").collect()]
    urls += [None, "", "no scheme/de/1", "http://", "http://ORG", "x://org/", "http://notorg/", "http://a.Example.ORG:80/es/q#://x", "http://example.org/en/12?x"]
    urls += ["http://h.net/de/2", "http://h.net/de/", "a://b://c/d", "http://u.com/fr/" + "s/" * 9, "http://q.com\n/de/\n", "http://x.com?/de/", "http://b.com/de/" + "é" * 60] * 2
    pages = local_table(spark, [(i, u, "") for i, u in enumerate(urls)], PAGES)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_templates.judge_urls(pages).collect()}
    want = brute_urls(urls)
    assert [got[i] for i in range(len(urls))] == want
    assert {v for _, _, rule, v in want if rule is None} == {"allow", "block"}
    assert url_templates.judge_urls(local_table(spark, [], PAGES)).count() == 0


def test_url_branches_below_the_fourth_segment(spark):
    rules = [(v, f"{h}.org", f"/p/q/r/s/{name}/") for h in "ab" for v, name in (("block", "bad"), ("allow", "good"))]
    rules += [("block", "c.org", "/" + "d/" * 7 + "x/"), ("allow", "c.org", "/" + "d/" * 7 + "y/")]
    urls = [f"http://{h}.org/p/q/r/s/{name}/w{i}" for h in "abz" for name in ("bad", "good") for i in range(12)]
    urls += [f"http://{h}.org/{'d/' * 7}{name}/w{i}/v" for h in "cy" for name in "xy" for i in range(12)]
    shape = "page_id long, url string, host string, path string, said string, segs string, labelled int, template int, seg int, tree int"
    pages = local_table(spark, [(i, u, "h", "p", "s", "g", 1, 2, 3, 4) for i, u in enumerate(urls)], shape)
    got = {r.page_id: r for r in url_templates.judge_urls(pages, rules).collect()}
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(urls))] == brute_urls(urls, rules)
    for i, u in enumerate(urls):
        assert got[i].verdict == ("block" if "/bad/" in u or "/x/" in u else "allow"), u
        assert got[i].template.count("/") == urls[i].count("/") - 2


TURNS = "conv_id long, turn long, role string, text string, place int"


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\n", "\\n \\\\ <\\s> [\\INST]", None, "", "<<SYS>> <</SYS>> <s>", "\U0001F600é\\"]
    rows = [(1, i, "assistant" if i % 2 else "user", t, 0) for i, t in enumerate(odd)]
    rows += [(2, 1, "user", "b", 0), (2, 0, "sys\ntem\\n", "a", 0), (3, 0, None, "x", 0), (3, 0, None, "x", 0), (3, None, "assistant", "first", 0)]
    rows += [(None, 0, "user", "u", 0), (None, 1, "assistant", "v", 0)]
    rows += [(9, i, "assistant" if i % 2 else "user", f"turn {i}", 0) for i in range(300)]
    formatted = chat.format_turns(local_table(spark, rows, TURNS))
    stored = formatted.collect()
    for r in stored:
        inner = r.segment[len(chat.OPEN) : -len(chat.CLOSE)]
        assert not re.search(r"</?s>|<\|\w+\||\[/?INST\]|<</?SYS>>", inner)
    got = {r.conv_id: r for r in chat.read_back(formatted, chat.examples(formatted)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        r = got[conv]
        loss = "".join(t or "" for _, _, role, t, _ in own if role == "assistant")
        assert r.n_turns == len(own)
        assert r.turns_sha256 == brute.sha("".join(f"{role or ''}\n{t or ''}\n" for _, _, role, t, _ in own))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), brute.sha(loss))
        assert r.formatted_chars == sum(len(s.segment) for s in stored if s.conv_id == conv)
        ends = [sum(len(s.segment) for s in stored if s.conv_id == conv and s.place <= k) for k, t in enumerate(own, 1) if t[2] == "assistant"]
        assert (r.n_examples, r.example_chars) == (len(ends), sum(ends))
    shown = chat.examples(formatted)
    assert shown.count() == sum(r[2] == "assistant" for r in rows)
    texts = {(r.conv_id, r.place): r for r in chat.render(formatted, shown.where("conv_id is null or conv_id < 9")).collect()}
    whole = "".join(s.segment for s in sorted((s for s in stored if s.conv_id == 1), key=lambda s: s.place))
    for e in shown.where("conv_id = 1").collect():
        t = texts[1, e.place]
        assert t.text == whole[: e.length]
        assert chat.unescaped(t.text[t.loss_first : t.loss_first + t.loss_chars]) == (odd[e.place - 1] or "")
    assert texts[None, 2].text.endswith("v<|im_end|>\n")
    none = chat.format_turns(local_table(spark, [], TURNS))
    assert chat.read_back(none, chat.examples(none)).count() == 0
