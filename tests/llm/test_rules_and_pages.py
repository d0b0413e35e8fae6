"""Quality rules, page text, decontamination and mixing beside plain Python."""

import math
import random
import re
from collections import Counter

import pytest

from vizquarry.llm import decontaminate, html_text, mixing, quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality rules ----------------------------------------------------------------------------------------------


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    inside = {j for k in range(len(words) - 7) if seen[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed


def rule_rows():
    draw = random.Random(8)
    common = "the of and to in that is was".split()
    rows = []
    for k in range(80):
        words = [draw.choice(common) if draw.random() < 0.4 else "".join(draw.choice("etaoin") for _ in range(6)) for _ in range(90)]
        rows.append((k, " ".join(words) + ".\n" + words[0] + "\n" * (k % 3) + words[0], "en"))
    shout = " ".join("".join(draw.choice("QWERTY") for _ in range(7)) + "!!" for _ in range(80))
    cells = " | ".join("".join(draw.choice("zxcvb") for _ in range(6)) for _ in range(80))
    rows += [(100, shout, "en"), (101, cells, "en"), (102, "a b c d e f g h " * 9, "en"), (103, None, "en"), (104, "", None)]
    rows += [(105, rows[0][1], None), (105, rows[1][1], "xx"), (None, rows[2][1], "en"), (106, "word " * 40_000, "zz"), (107, "\v x\x0c\n\n x", "en")]
    return rows


def test_rules(spark):
    rows = rule_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS ref", "2 AS n_words")
    got = rules.quality_rules(docs).collect()
    want = sorted(((k, *counts(t)) for k, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str) == want
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[k] for k in range(80)) and not any(kept[k] for k in (100, 101, 102, 103, 104, 106))
    assert rules.quality_rules(docs.limit(0)).count() == 0


def test_common_words_and_distances(spark):
    """Distances as plain Python has them, with references over all documents of a language."""
    rows = [r for r in rule_rows() if r[2] == "en" and r[1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = {r.doc_id: r for r in rules.quality_rules(docs, share=0.02).collect()}
    table = rules.class_table()
    words, classes = Counter(), Counter()
    for _, text, _ in rows:
        words.update(WORD.findall(text))
        classes.update(int(table[ord(c)]) for c in text)
    total = sum(words.values())
    common = [w for w, n in words.items() if n >= 0.02 * total]
    assert len(common) > 3

    def distance(p, q):
        m = [(a + b) / 2 for a, b in zip(p, q)]
        kl = lambda x: sum(a * math.log2(a / c) for a, c in zip(x, m) if a > 0)
        return math.sqrt(max(0, (kl(p) + kl(q)) / 2))

    def shares(counter, n):
        found = [counter[w] / n for w in common]
        return [*found, 1 - sum(found)]

    for key, text, _ in rows:
        own = WORD.findall(text)
        if len(own) >= rules.LEAST_WORDS:
            assert got[key].word_distance == pytest.approx(distance(shares(Counter(own), len(own)), shares(words, total)), abs=1e-6)
        if len(text) >= rules.LEAST_CHARS:
            mine = Counter(int(table[ord(c)]) for c in text)
            every = sum(classes.values())
            want = distance([mine[k] / len(text) for k in range(6)], [classes[k] / every for k in range(6)])
            assert got[key].class_distance == pytest.approx(want, abs=1e-6)


# --- pages ------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<header><p>Site, head, line, with, commas, and more commas, to score.</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="ad">Buy, buy, buy, this, now, please, dear, reader.</div>{body}
<div id="comments"><p>First, a comment, which is long, and has commas, many of them.</p></div>
<aside>Side</aside><form><p>Mail, please, here</p></form><footer>&copy; foot</footer></body></html>"""


@pytest.mark.parametrize(
    ("body", "text"),
    [
        ("<article><h1>A  title</h1><p>One, two &amp; three.</p>\n<p>Four\n five</p></article>", "A title\nOne, two & three.\nFour five"),
        ("<article><p><b>One, two.<br><p>Three</p><p></p></article>", "One, two.\nThree"),
        ("<div><div><p>Some text, long enough, to be the article, of this page.</p><p>More of it, at length.</p></div></div>",
         "Some text, long enough, to be the article, of this page.\nMore of it, at length."),
        ("<main><section><p>Part one, with text.</p></section><section><p>Part two, with text.</p></section></main>", "Part one, with text.\nPart two, with text."),
        ("<article><p>Short</p></article>", "Short"),
        ("<article>Bare text, no block<br>next</article>", "Bare text, no block next"),
        ("<article><p>A&nbsp;b &#65; &lt;i&gt;</p><pre>x\n  y</pre><ul><li>i<li>ii</ul></article>", "A b A <i>\nx y\ni\nii"),
        ("<article><p>Kept.</p><div class='share'>Tell, all, your, friends</div><p>Kept too.</p></article>", "Kept.\nKept too."),
        ("", ""),
    ],
)
def test_main_text(body, text):
    assert html_text.main_text(PAGE.format(body=body)) == text


def test_pages(spark):
    good = PAGE.format(body="<article><p>Text, of the page.</p></article>")
    rows = [(1, "u", good), (1, "u", good), (2, None, None), (None, "v", ""), (3, "w", "<p"), (4, "x", "no tags at all"), (5, "y", "<div>" * 3000 + "deep, text")]
    rows.append((6, "z", "<article>" + "<p>Long, line.</p>" * 20_000 + "</article>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = html_text.extract_text(pages).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[1] == "Text, of the page." and by_id[2] == by_id[None] == "" and by_id[4] == "no tags at all"
    assert by_id[5] == "deep, text" and by_id[6].count("\n") == 19_999
    assert html_text.extract_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("odd", ["<![foo bar]>", "<![ b>", "<![>", "<![if x", "<![CDATA[ x", "<![foo", "<!-", "<!>", "<!foo [x]>"])
def test_odd_declarations_end_nothing(odd):
    assert html_text.main_text(f"<article><p>Before, it stands.</p>{odd}</article>").startswith("Before, it stands.")
    if odd.endswith(">"):
        assert html_text.main_text(f"<p>a {odd} b</p>") == "a b"


LONG = "<p>Some text, long enough, to be the article, of this page.</p><p>More of it, at length, follows here.</p>"
LONG_TEXT = "Some text, long enough, to be the article, of this page.\nMore of it, at length, follows here."


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><meta charset=utf-8><body><div>{LONG}</div></body></html>",
    f"<head><title>T</title><div>{LONG}</div>",
    f"<head><title>T</title><noscript><p>Off</p></noscript><article>{LONG}</article>",
])
def test_open_head(page):
    assert html_text.main_text(page) == LONG_TEXT


@pytest.mark.parametrize("name", ["content no-sidebar", "has-sidebar", "with-banner", "page-widget"])
@pytest.mark.parametrize("inner", ["{}", "<article>{}</article>", "<main>{}</main>"])
def test_wrapper_named_like_a_part(name, inner):
    comments = "<div class='comments'>" + "<p>So, well, I, for one, think, this, is, too, long, by, far.</p>" * 9 + "</div>"
    page = f"<body><div class='{name}'>{inner.format(LONG)}<div class='sidebar'><p>Side, only.</p></div></div>{comments}</body>"
    assert html_text.main_text(page) == LONG_TEXT


# --- decontamination --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_contaminated(spark, limit):
    draw = random.Random(2)
    word = lambda: "".join(draw.choice("abcdefg") for _ in range(4))
    items = [(k, " ".join(word() for _ in range(draw.choice((5, 9, 17, 40))))) for k in range(12)]
    items += [(20, None), (21, ""), (22, "too few words"), (None, "no id for this item at all"), (3, items[3][1])]
    docs = []
    for k in range(60):
        words = [word() for _ in range(draw.randrange(3, 400))]
        for _ in range(draw.randrange(0, 3)):
            own = (draw.choice(items[:12])[1]).split()
            if draw.random() < 0.4:
                own[draw.randrange(len(own))] = word()
            at = draw.randrange(len(words))
            words[at:at] = own
        docs.append((k, "\n ".join(words).upper() if k % 2 else " ".join(words)))
    docs += [(70, None), (71, ""), (None, items[0][1]), (72, items[1][1]), (72, items[1][1]), (73, ("pad " * 50_000) + items[2][1])]

    def sets(rows):
        found = {}
        for key, text in rows:
            w = WORD.findall((text or "").lower())
            if key is not None:
                found.setdefault(key, set()).update(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        return found

    own, theirs = sets(docs), sets(items)
    want = sorted((d, i, len(a & b), len(b)) for d, a in own.items() for i, b in theirs.items() if b and 100 * len(a & b) >= 80 * len(b))
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS words", "2 AS h1", "'x' AS item_id")
    listed = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'y' AS place")
    assert len(want) > 20
    assert sorted(map(tuple, decontaminate.contaminated(frame, listed, broadcast_rows=limit).collect())) == want
    assert decontaminate.contaminated(frame.limit(0), listed).count() == decontaminate.contaminated(frame, listed.limit(0)).count() == 0


# --- mixing -----------------------------------------------------------------------------------------------------


def fill(total, children):
    """(name, capacity, weight) to budgets, by handing out what is left again and again."""
    budget, open_ = dict.fromkeys([c[0] for c in children], 0.0), [c for c in children if c[2] > 0]
    while open_ and total > 1e-9:
        weights = sum(c[2] for c in open_)
        given = {c[0]: min(c[1] - budget[c[0]], total * c[2] / weights) for c in open_}
        for name, x in given.items():
            budget[name] += x
        total -= sum(given.values())
        left = [c for c in open_ if c[1] - budget[c[0]] > 1e-9]
        if len(left) == len(open_):
            break
        open_ = left
    return budget


@pytest.mark.parametrize(("share", "epochs"), [(0.5, 1), (0.3, 3), (2.0, 3), (9.0, 2), (0.0, 1)])
def test_mixing(spark, monkeypatch, share, epochs):
    draw = random.Random(6)
    rows = []
    for k in range(400):
        source = draw.choice(["a"] * 6 + ["b", "c", None])
        rows.append((k, draw.choice(["x", "x", "y"]), source, draw.choice([0, 1, 5, 9, 40])))
    rows += [(7, "x", "a", 3), (None, "x", "a", 4), (None, None, None, 5)]
    weights = {("x",): 3.0, ("y", "b"): 0.0, ("x", "a"): 5.0}
    frame = spark.createDataFrame(rows, "doc_id long, p string, q string, n_tokens long").selectExpr("*", "1 AS whole", "2 AS last", "3 AS rest")
    marked = mixing.with_levels(frame, {"l1": frame.p, "l2": frame.q})
    for limit in (100_000, 0):
        monkeypatch.setattr(mixing, "BROADCAST_LEAVES", limit)
        leaves = mixing.plan(marked, ["l1", "l2"], weights, share, epochs, seed=5)
        got = mixing.taken(marked, leaves, ["l1", "l2"], seed=5)
        copies = sorted(((r.doc_id, r.l1, r.l2, r.n_tokens, r._mix_copies) for r in got.collect()), key=str)
        supply = Counter()
        for _, p, q, n in rows:
            supply[p or "(none)", q or "(none)"] += n
        tops = sorted({p for p, _ in supply})
        top = fill(share * sum(supply.values()), [(p, epochs * sum(n for (x, _), n in supply.items() if x == p), weights.get((p,), 1.0)) for p in tops])
        want = []
        for p in tops:
            inner = fill(top[p], [(leaf, epochs * n, weights.get(leaf, 1.0)) for leaf, n in supply.items() if leaf[0] == p])
            for leaf, budget in inner.items():
                if weights.get(leaf, 1.0) == 0:
                    continue
                budget = math.floor(budget + 1e-6)
                whole = budget // supply[leaf] if supply[leaf] else 0
                rest, run = budget - whole * supply[leaf], 0
                import hashlib

                place = lambda key: hashlib.md5(":".join(["5", str(whole)] + ([] if key is None else [str(key)])).encode()).hexdigest()  # noqa: B023,E731
                own = sorted((place(k), str(k), k, n) for k, p, q, n in rows if (p or "(none)", q or "(none)") == leaf)
                start = {}
                for h, _, _, n in own:
                    start.setdefault(h, run)
                    run += n
                for h, _, k, n in own:
                    times = whole + (start[h] < rest)
                    if times:
                        want.append((k, *leaf, n, times))
        assert copies == sorted(want, key=str)
    empty = mixing.with_levels(frame.limit(0), {"l1": frame.p, "l2": frame.q})
    assert mixing.taken(empty, mixing.plan(empty, ["l1", "l2"], weights, share, epochs), ["l1", "l2"]).count() == 0


LOST_BEFORE = [
    ("<body><article><p>One, two, three and so on.</p><p>More of it, and more.</p></article><article><h2>Second</h2><p>Short.</p></article></body>",
     "One, two, three and so on.\nMore of it, and more.\nSecond\nShort."),
    ("<body><div class='part1'><p>A first, long part.</p><p>It goes on, as it does.</p><p>And on, again.</p></div><div class='part2'>A short closing part.</div></body>",
     "A first, long part.\nIt goes on, as it does.\nAnd on, again.\nA short closing part."),
    ("<body><div><p>A first, long part.</p><p>It goes on, as it does.</p></div><p>No full stop</p></body>",
     "A first, long part.\nIt goes on, as it does.\nNo full stop"),
    ("<body><article><p>The beginning, and so on.</p><div class='social-history'><p>a long sentence of the article</p></div></article></body>",
     "The beginning, and so on.\na long sentence of the article"),
    ("<body><article><p>Press <button>now</button>, please.</p><p>Then the <label>name</label> shows, at last.</p></article></body>",
     "Press now, please.\nThen the name shows, at last."),
    # What still goes.
    ("<body><article><p>The text, as it is.</p><div class='share'>Share this text</div><div class='ad-box'>Buy, buy.</div>"
     "<div class='related-posts'><a href='x'>Other</a> <a href='y'>Another</a></div><p><button>Like</button></p></article>"
     "<article class='comment'><p>I read it, all of it, and more, and more, and yet more.</p></article><p><a href='z'>Next page</a></p></body>",
     "The text, as it is."),
]


@pytest.mark.parametrize(("html", "text"), LOST_BEFORE)
def test_no_part_of_the_article_is_lost(html, text):
    assert html_text.main_text(html) == text
