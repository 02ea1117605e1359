import math
from collections import Counter

from plantmetrics.llm import url_markov as U

SCHEMA = "page_id long, url string, host string, verdict int"
URLS = [
    None, "", "no scheme/en/", "http://Example.COM/en/x?q#f", "https://www.example.com/en/1", "http://a.b.net/es/9", "http://net/fr/", "http://x.com",
    "http://x.com/", "http://notexample.com/en/", "mailto://a.org/en/7?x=://b.com/", "http://a.org/en/7", "http://a.org/en/7", "http://ÄÖ.org/\n/x",
    "http://cheap.net/es/" + "z" * 20000, "http://y.com/shop", "http://z.com/shop/2",
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for k, c in enumerate(rest):
        if c in "/?#":
            break
    else:
        k = len(rest)
    path = rest[k:]
    for mark in "?#":
        path = path.split(mark)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:k]), path


def rule(host, path):
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def test_host_path_rule_and_verdict(frame):
    rows = U.judge_urls(frame([(k, u, "clash", 1) for k, u in enumerate(URLS)], SCHEMA)).collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == len(URLS)
    for k, url in enumerate(URLS):
        host, path = split(url)
        best = rule(host, path)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, best.name if best else None)
        assert got[k].verdict == (best.verdict if best else got[k].verdict) and got[k].verdict in ("allow", "block")
    assert got[11].verdict == got[12].verdict and got[11].score_bin == got[12].score_bin


def test_scores_are_those_of_the_model(frame):
    import hashlib

    urls = [f"http://good{k}.com/news/{k}" for k in range(30)] + [f"http://bad{k}.net/es/spam{k}" for k in range(30)] + ["http://q.org/news/1", "http://q.org/es/spam1"]
    rows = U.judge_urls(frame([(k, u, "", 0) for k, u in enumerate(urls)], SCHEMA)).collect()
    counts = {"allow": Counter(), "block": Counter()}
    strings = {k: f"^^^{u}$" for k, u in enumerate(urls)}
    for k, s in strings.items():
        fit = rule(*split(urls[k]))
        if fit and not "0" <= hashlib.md5(s.encode()).hexdigest()[0] <= "3":
            for i in range(len(s) - 3):
                for n in range(4):
                    counts[fit.verdict][s[i + 3 - n:i + 4]] += 1
                    counts[fit.verdict]["of" + s[i + 3 - n:i + 3]] += 1

    def chance(kind, gram):
        p = 1 / U.SIGNS
        for n in range(4):
            p = (counts[kind][gram[3 - n:]] + p) / (counts[kind]["of" + gram[3 - n:3]] + 1)
        return p

    for row in rows:
        s = strings[row.page_id]
        grams = [s[i:i + 4] for i in range(len(s) - 3)]
        micro = [round((math.log(chance("allow", g)) - math.log(chance("block", g))) * 1e6) for g in grams]
        assert abs(row.score_bin - min(max(math.floor(sum(micro) / len(micro) / 1000), -U.WIDEST), U.WIDEST)) <= 1
    verdict = {r.page_id: r.verdict for r in rows}
    assert (verdict[60], verdict[61]) == ("allow", "block")


def test_queries_fragments_and_urls_without_scheme_are_read(frame):
    tails = ("?page=2&q=news", "#top+of"), ("?aff=zz&buy=1", "#cheap")
    urls = [f"http://s{k}.com/p{tails[0][k % 2]}" for k in range(60)] + [f"http://s{k}.net/es/p{tails[1][k % 2]}" for k in range(60)]
    asked = ["http://q.org/p?page=2&q=news", "http://q.org/p?aff=zz&buy=1", "/p?page=2&q=news", "/es/p?aff=zz&buy=1", None]
    rows = U.judge_urls(frame([(k, u, "", 0) for k, u in enumerate(urls + asked)], SCHEMA)).collect()
    bins = [r.score_bin for r in sorted(rows, key=lambda r: r.page_id)[-len(asked):]]
    assert bins[0] > bins[1] and bins[2] > bins[3] and len(set(bins)) == len(asked)


def test_without_labels_and_without_rows(frame):
    assert [r.verdict for r in U.judge_urls(frame([(1, "http://a.org/x", "", 0), (None, None, "", 0)], SCHEMA)).collect()] == ["allow", "allow"]
    assert U.judge_urls(frame([], SCHEMA)).count() == 0
