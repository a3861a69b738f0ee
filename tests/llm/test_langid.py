import html
import math
import random
import re
from collections import Counter

from cohortlens.llm import langid

PAGES = "page_id long, url string, html string, lang string, host int"


def words(lang, r, n):
    syl = {"xx": ["ta", "ro", "mi", "ke"], "yy": ["sch", "ung", "ei", "ver"], "zz": ["que", "ção", "lh", "os"]}[lang]
    return " ".join("".join(r.choice(syl) for _ in range(r.randint(1, 4))) for _ in range(n))


def test_fusion(spark):
    r = random.Random(1)
    docs = spark.createDataFrame([(i, words(x, r, 60), x) for i in range(90) for x in [["xx", "yy", "zz"][i % 3]]] + [(None, "a", "xx"), (900, None, "yy"), (901, "b", None)],
                                 "doc_id long, text string, lang string")
    rows, truth = [], {}
    for i in range(240):
        x = ["xx", "yy", "zz"][i % 3]
        body = words(x, r, 40) if i % 8 else ""      # some pages have no text: the host and the tag decide
        tag = f'<html lang="{x}-XX">' if i % 5 else "<html>"
        rows.append((i, f"https://www.{x}{i % 4}.example.{x}/p?q", f"{tag}<head><script>var a='{words('xx', r, 30)}'</script><!-- {words('yy', r, 9)} --></head><p>{body}</p>", "q", 1))
        truth[i] = x
    rows += [(1000, None, None, "q", 1), (1001, "no url", "", "q", 1), (1002, "http://u:p@H.Example.xx:80/", "<p>" + words("xx", r, 20_000), "q", 1), (1002, "http://u:p@H.Example.xx:80/", "<p>", "q", 1)]
    got = langid.identify(spark.createDataFrame(rows, PAGES), docs).collect()
    by = {x.page_id: x for x in got}
    assert len(got) == 244 and {x.host for x in got if x.page_id == 1002} == {"h.example.xx"}
    assert sum(by[i].lang == t for i, t in truth.items()) >= 238
    assert by[1000].declared == "none" and by[1000].host == "" and 0 < by[1000].posterior <= 1


def test_shares_are_smoothed_towards_the_domain(spark):
    """A page without text in a new host follows its domain, not the whole."""
    r = random.Random(3)
    docs = spark.createDataFrame([(i, words(x, r, 60), x) for i in range(60) for x in [["xx", "yy"][i % 2]]], "doc_id long, text string, lang string")
    rows = [(i, f"http://h{i % 7}.big.net/", words("xx", r, 50), "", 0) for i in range(300)]
    rows += [(1000 + i, f"http://h{i % 7}.small.net/", words("yy", r, 50), "", 0) for i in range(30)]
    rows += [(5000, "http://new.small.net/", "", "", 0), (5001, "http://new.big.net/", "", "", 0)]
    by = {x.page_id: x.lang for x in langid.identify(spark.createDataFrame(rows, PAGES), docs).collect()}
    assert by[5000] == "yy" and by[5001] == "xx"


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b c", "xx")], "doc_id long, text string, lang string")
    assert langid.identify(spark.createDataFrame([], PAGES), docs).collect() == []
    none = langid.identify(spark.createDataFrame([(1, "http://a.b/", "<p>x", "", 0)], PAGES), docs.limit(0)).collect()
    assert [(x.page_id, x.lang, x.posterior) for x in none] == [(1, None, None)]


def reference(pages, docs, strength=langid.STRENGTH):
    """The fusion in plain Python, page by page, with trigrams as texts."""
    letters = lambda t: f" {re.sub(r'[\W\d_]+', ' ', t.lower()).strip()} "
    grams = lambda t: [letters(t)[i:i + 3] for i in range(len(letters(t)) - 2)]
    cell = {}
    def cells(t):
        for g in grams(t):
            if g not in cell:
                cell[g] = int(langid.cells_of(g)[0])
        return [cell[g] for g in grams(t)]
    langs = sorted({x for *_, x in docs})
    n = {x: Counter(c for _, t, y in docs if y == x for c in cells(t)) for x in langs}
    size = {x: sum(n[x].values()) + 0.5 * langid.CELLS for x in langs}
    rows = []
    for i, url, page in pages:
        text = html.unescape(re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ", page or ""))
        ll = [sum(math.log((n[x][c] + 0.5) / size[x]) for c in cells(text)) / langid.OVERLAP for x in langs]
        e = [math.exp(v - max(ll)) for v in ll]
        tag = re.search(r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]+)", page or "")
        host = (re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "") or ["", ""])[1].lower().rstrip(".")
        parts = host.split(".")
        rows.append((i, ll, [v / sum(e) for v in e], {"declared": tag[1].lower() if tag else "none", "suffix": parts[-1], "domain": ".".join(parts[-2:]), "host": host}))
    k = range(len(langs))
    whole = [sum(p[j] for _, _, p, _ in rows) for j in k]
    base = [(w + 1 / len(langs)) / (sum(whole) + 1) for w in whole]
    out = {}
    for i, ll, p, keys in rows:
        total = lambda key: [sum(q[j] for _, _, q, o in rows if o[key] == keys[key]) for j in k]
        shares = base
        for key in ("domain", "host"):
            rest = [max(a - b, 0) for a, b in zip(total(key), p)]
            shares = [(a + strength * s) / (sum(rest) + strength) for a, s in zip(rest, shares)]
        score = [a + math.log(s) for a, s in zip(ll, shares)]
        for key in ("declared", "suffix"):
            values = len({o[key] for *_, o in rows})
            score = [a + math.log((c + 1) / (w + values)) for a, c, w in zip(score, total(key), whole)]
        e = [math.exp(v - max(score)) for v in score]
        out[i] = (langs[score.index(max(score))], max(e) / sum(e), langs[ll.index(max(ll))], keys["declared"], keys["host"])
    return out


def test_against_plain_python(spark):
    r = random.Random(8)
    docs = [(i, words(x, r, 30), x) for i in range(30) for x in [["xx", "yy", "zz"][i % 3]]]
    pages = []
    for i in range(120):
        x = r.choice(["xx", "yy", "zz"])
        tag = f'<html lang="{r.choice([x, x, "qq"])}">' if i % 3 else ""
        pages.append((i, r.choice([f"http://{x}{i % 3}.site.{x}/", "https://u@hot.example.org:8/p", None, "nothing"]), f"{tag}<p>{words(x, r, r.choice([0, 1, 3]))} &amp; 12<script>{words('xx', r, 5)}</script>"))
    got = langid.identify(spark.createDataFrame([(*p, "", 0) for p in pages], PAGES), spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    want = reference(pages, docs)
    assert len(got) == len(pages)
    for x in got:
        lang, posterior, text_lang, declared, host = want[x.page_id]
        assert (x.lang, x.declared, x.host) == (lang, declared, host) and abs(x.posterior - posterior) < 1e-4
        assert x.text_lang == text_lang or not pages[x.page_id][2].replace("&amp; 12", "")


def test_an_id_with_many_rows_counts_once(spark):
    """The sample holds distinct ids, and one text of each."""
    r = random.Random(9)
    docs = [(7, words("xx", r, 20), "xx")] * 200 + [(i, words("xx", r, 20), "xx") for i in range(100, 130)] + [(i, words("yy", r, 20), "yy") for i in range(200, 230)]
    schema = "doc_id long, text string, lang string"
    langs, many = langid.train(spark.createDataFrame(docs, schema), per_lang=20)
    _, once = langid.train(spark.createDataFrame(docs[199:], schema), per_lang=20)
    assert langs == ["xx", "yy"] and (many == once).all()
