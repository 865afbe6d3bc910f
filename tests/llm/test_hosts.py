import re
from collections import Counter, defaultdict

import pytest
from labelscope.llm import hosts

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
DDL = "page_id long, url string, html string, host int, mass string"


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, re.match("[^?#]*", rest[len(host):])[0]


def ruled(host, path):
    best = None
    for rule, verdict in RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return best or (None, None)


def walk(links, seeds, rounds=10, damping=0.85):
    total = sum(seeds.values())
    if not total or not links:
        return {h: w / total for h, w in seeds.items()} if total else {}
    start = {h: w / total for h, w in seeds.items()}
    out, mass = Counter(), dict(start)
    for (a, _), n in links.items():
        out[a] += n
    for _ in range(rounds):
        new = defaultdict(float, {h: m * (1 - damping) for h, m in start.items()})
        for (a, b), n in links.items():
            new[b] += damping * mass.get(a, 0) * n / out[a]
        mass = new
    return mass


def brute(rows):
    kinds, links = defaultdict(Counter), Counter()
    for _, url, html, *_ in rows:
        host, path = split(url)
        if host:
            kinds[host]["all"] += 1
            kinds[host][ruled(host, path)[1]] += 1
            for link in re.findall("(?:href|src)=\"(https?://[^\"]+)", html or ""):
                if split(link)[0] not in ("", host):
                    links[host, split(link)[0]] += 1
    seeds = lambda kind: {h: c[kind] for h, c in kinds.items() if 2 * c[kind] > c["all"]}
    trust, bad = walk(links, seeds("allow")), walk({(b, a): n for (a, b), n in links.items()}, seeds("block"))
    out = []
    for i, url, *_ in rows:
        host, path = split(url)
        rule, verdict = ruled(host, path)
        out.append((i, host, path, rule, verdict or ("block" if round(trust.get(host, 0) - bad.get(host, 0), 12) < 0 else "allow")))
    return sorted(map(repr, out))


def test_against_brute_force(frame):
    link = lambda *names: "".join(f'<a href="http://{n}/x">' for n in names)
    rows = [
        (1, "http://A.com/x?y", link("b.org", "b.org", "c.org")), (2, "https://www.Example.com/en/1", link("a.com")), (3, "http://example.com/en/", ""),
        (4, "http://m.example.com/en/4#t", None), (5, "http://example.com/de", "<img src='http://d.org/p'>"[:0]), (6, "http://x.net/es/1", link("e.org")),
        (7, "http://x.net/fr/2", ""), (8, "http://x.net/de/3", ""), (9, "http://b.org/", link("x.net")), (10, "http://c.org", link("b.org")),
        (11, "http://d.org/1", link("x.net", "a.com")), (12, "http://e.org/q", link("d.org")), (13, None, link("x.net")), (14, "no scheme", ""), (15, "", ""),
        (16, "http://com/", ""), (17, "http://com?x=/", ""), (18, "http://dotcom/", ""), (19, "x://?q", ""), (20, "http://ÄB.org/%", ""), (9, "http://b.org/", link("x.net")),
        (None, "a://b.net/es/://", ""), (21, "http://f.org/", link("f.org", "x.net")),
    ]
    found = hosts.judge(frame([(*r, 0, "") for r in rows], DDL), RULES)
    assert sorted(repr(tuple(r)) for r in found.collect()) == brute(rows)
    assert {r.verdict for r in found.where("rule is null and host <> ''").collect()} == {"allow", "block"}


def verdicts(frame, rows):
    return {r.host: r.verdict for r in hosts.judge(frame([(k, f"http://{a}/", html, 0, "") for k, (a, html) in enumerate(rows)], DDL), (("bad/", "block"),)).collect()}


def test_small_mass_counts(frame, monkeypatch):
    links = [("far.org", "hub.org", 1), ("hub.org", "m.org", 1), ("m.org", "bad", 1)]
    links += [(f"x{k}.org", to, 10**6) for k, to in enumerate(("bad", "m.org", "hub.org"))]  # others get nearly all of the distrust
    monkeypatch.setattr(hosts, "host_links", lambda pages: frame(links, "from string, to string, links long"))
    assert verdicts(frame, [("bad", ""), ("far.org", ""), ("free.org", "")]) == {"bad": "block", "far.org": "block", "free.org": "allow"}


def test_far_hosts_and_links_without_scheme(frame):
    rows = [("bad", "")] + [(f"h{k}.org", f"<a href='//{'bad' if k == 0 else f'h{k - 1}.org'}/x'>") for k in range(14)]
    assert set(verdicts(frame, rows).values()) == {"block"}


def test_empty(frame):
    assert hosts.judge(frame([], DDL), RULES).collect() == []
    assert hosts.judge(frame([(1, "http://a.org/", None, 0, "")], DDL), ()).collect()[0].verdict == "allow"
