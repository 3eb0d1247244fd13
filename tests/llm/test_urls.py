import re

from callops.llm import urls
from callops.llm.queries import QUERIES, URL_RULES
from llm_samples import FOLDER, table  # noqa: F401

SCHEMA = "page_id long, url string, html string"


def judged(df, rules=URL_RULES, **given):
    return sorted((tuple(r) for r in urls.judge(df, rules, **given).collect()), key=repr)


def test_hosts_paths_and_rules(table):  # noqa: F811
    cases = [("http://A.Example.COM/en/1?x#y", "a.example.com", "/en/1", "example.com/en/", "block"),
             ("HTTPS://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
             ("http://x.www.example.com/en/z", "x.www.example.com", "/en/z", "www.example.com/en/", "allow"),
             ("http://example.com", "example.com", "", None, "allow"),
             ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
             ("http://net/es/", "net", "/es/", "net/es/", "block"), ("ftp://É.net/es/?u=http://b.com/", "É.net", "/es/", "net/es/", "block"),
             ("a?b://c.net/fr/x", "c.net", "/fr/x", "net/fr/", "block"), ("://q.net?/es/", "q.net", "", None, "allow"),
             ("http://h.org#a/b", "h.org", "", None, "allow"), ("no scheme", "", "", None, "allow"), ("", "", "", None, "allow"),
             (None, "", "", None, "allow"), ("x\ny://n.com/\nz", "n.com", "/\nz", "com/", "allow")]
    rows = [(k, u, None) for k, (u, *_) in enumerate(cases)]
    assert judged(table(rows + rows[:1], SCHEMA)) == sorted([(k, *c[1:]) for k, c in enumerate(cases)] + [(0, *cases[0][1:])], key=repr)


def propagated(links, seeds, rounds, damping=0.85):
    total, wave = dict(seeds), dict(seeds)
    out = {a: sum(n for (x, _), n in links.items() if x == a) for a, _ in links}
    for _ in range(rounds):
        new = {}
        for (a, b), n in links.items():
            if a in wave:
                new[b] = new.get(b, 0) + damping * wave[a] * n / out[a]
        wave = new
        for host, mass in wave.items():
            total[host] = total.get(host, 0) + mass
    return total


def test_trust_follows_links_and_distrust_goes_back(spark, table):  # noqa: F811
    links = {("good.com", "friend.org"): 3, ("good.com", "other.org"): 1, ("farm.org", "bad.net"): 2, ("far.org", "farm.org"): 1,
             ("friend.org", "far.org"): 1, ("other.org", "good.com"): 2}
    rows = [(1, "http://good.com/", "".join(f'<a class=x HREF="http://{b.upper()}/p">' * n for (a, b), n in links.items() if a == "good.com")),
            (2, "http://bad.net/es/", "<a href='/own'> <a href=relative>"), (3, "http://bad.net/es/2", None)]
    for k, host in enumerate(("friend.org", "other.org", "farm.org", "far.org", "lonely.org")):
        rows.append((10 + k, f"http://{host}/", "".join(f"<p><a href='//{b}'>" * n for (a, b), n in links.items() if a == host)))
    found = urls.propagate(
        spark.createDataFrame([("trust", "good.com", 1.0), ("distrust", "bad.net", 2.0)], "kind string, host string, score double"),
        spark.createDataFrame([(*k, n) for k, n in links.items()], "source string, target string, links long"), 0.85, 7)
    told = {(r.kind, r.host): r.score for r in found.collect()}
    back = {(b, a): n for (a, b), n in links.items()}
    expected = {("trust", h): v for h, v in propagated(links, {"good.com": 1.0}, 7).items()}
    expected |= {("distrust", h): v for h, v in propagated(back, {"bad.net": 2.0}, 7).items()}
    assert told.keys() == expected.keys() and all(abs(told[k] - v) < 1e-9 for k, v in expected.items())

    trust, distrust = propagated(links, {"good.com": 1.0}, urls.ROUNDS), propagated(back, {"bad.net": 2.0}, urls.ROUNDS)
    verdicts = {r[1]: r[4] for r in judged(table(rows, SCHEMA)) if r[3] is None}
    hosts = {"friend.org", "other.org", "farm.org", "far.org", "lonely.org"}
    assert verdicts == {h: "block" if distrust.get(h, 0) - trust.get(h, 0) > urls.THRESHOLD else "allow" for h in hosts}
    assert verdicts["farm.org"] == "block" and verdicts["lonely.org"] == "allow"


def test_distrust_goes_back_any_number_of_links(table):  # noqa: F811
    rows = [(k, "http://bad.net/es/", None) for k in range(100)]
    rows += [(100 + k, f"http://h{k}.org/", f"<a href='//{f'h{k - 1}.org' if k else 'bad.net'}'>") for k in range(40)]
    verdicts = {r[0]: r[4] for r in judged(table(rows, SCHEMA)) if r[0] >= 100}
    assert verdicts == {100 + k: "block" if 100 * 0.85 ** (k + 1) > 0.5 else "allow" for k in range(40)}
    assert verdicts[100 + 20] == "block" and verdicts[139] == "allow"


def test_what_a_cycle_of_links_gathers(spark, table):  # noqa: F811
    links = {("a.org", "bad.net"): 1, ("a.org", "b.org"): 1, ("b.org", "a.org"): 1}
    scores = urls.propagate(
        spark.createDataFrame([("distrust", "bad.net", 1.0)], "kind string, host string, score double"),
        spark.createDataFrame([(*k, n) for k, n in links.items()], "source string, target string, links long"), 0.85, None)
    told = {r.host: r.score for r in scores.collect()}
    limit = propagated({(b, a): n for (a, b), n in links.items()}, {"bad.net": 1.0}, 500)
    assert told.keys() == limit.keys() and all(0 <= limit[h] - told[h] < urls.TOLERANCE for h in limit)

    rows = [(1, "http://bad.net/es/", None), (2, "http://a.org/", "<a href='//bad.net'><a href='//b.org'>"), (3, "http://b.org/", "<a href='//a.org'>")]
    rows += [(10 + k, "http://a.org/more", None) for k in range(5)]  # six pages: 3.06 in the end is more than 3, 2.63 after 12 links is not
    assert {r[4] for r in judged(table(rows, SCHEMA)) if r[1] == "a.org"} == {"block"}


def test_empty_and_no_python(spark, table):  # noqa: F811
    assert judged(table([], SCHEMA)) == []
    plan = QUERIES["op2_url_filters"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
