import random
import re

from labelscope.llm import quotes

DDL = "conv_id long, turn long, role string, text string, level int, path string"


def parsed(text):
    lines = []
    for raw in re.split("\r?\n", text or ""):
        head = re.match(r"[ \t]*(?:>[ \t]*)*", raw)[0]
        lines.append((head.count(">"), re.sub(r"\s+", " ", raw[len(head):].lower()).strip(" "), raw))
    return lines


def brute(rows):
    levels = [{(n, t) for n, t, _ in parsed(x[3]) if t} for x in rows]
    parent = {}
    for a, (conv, turn, *_) in enumerate(rows):
        votes = {}
        for n, t in levels[a]:
            if n and conv is not None and turn is not None:
                seen = [rows[b][1] for b in range(len(rows)) if rows[b][0] == conv and rows[b][1] is not None and rows[b][1] < turn and (n - 1, t) in levels[b]]
                if seen:
                    votes[max(seen)] = votes.get(max(seen), 0) + 1
        if votes:
            parent[conv, turn] = max((v, k) for k, v in votes.items())[1]
    out = []
    for conv, turn, role, text, *_ in rows:
        path, at = [turn], turn
        while (conv, at) in parent:
            at = parent[conv, at]
            path.insert(0, at)
        content = "\n".join(raw for n, _, raw in parsed(text) if not re.match(r"[ \t]*>", raw)).strip()
        out.append((conv, turn, role, parent.get((conv, turn)), len(path) - 1, "/".join(str(p) for p in path if p is not None), content))
    return out


def sample():
    r, rows = random.Random(2), []
    for conv in range(6):
        said = []
        for turn in range(9):
            own = [f"Line {r.randrange(40)}  of talk" for _ in range(r.randint(1, 3))]
            quote = []
            if said and r.random() < 0.7:
                quote = ["> " + x if not x.startswith(">") else ">" + x for x in r.choice(said)]
            said.append(quote + own)
            rows.append((conv, turn, ["user", "assistant"][turn % 2], "\n".join(quote + own).replace("Line 7", "LINE 7"), 0, ""))
    rows += [(0, 100, None, "> nothing said\n\n answer \n", 0, ""), (7, 0, "user", None, 0, ""), (7, 1, "user", ">>", 0, ""), (7, 2, "user", "", 0, "")]
    rows += [(8, k, "user", f"> step {k - 1}\nstep {k}\r\n", 0, "") for k in range(40)]
    return rows


def test_against_brute_force(frame):
    rows = sample()
    found = quotes.conversations(frame(rows, DDL)).collect()
    assert sorted(map(repr, (tuple(r)[:7] for r in found))) == sorted(map(repr, brute(rows)))
    assert max(r.depth for r in found) == 39
    keys = [(r.conv_id, [int(x) for x in r.thread.split("/")]) for r in found]
    assert keys == sorted(keys)
    assert all(r.formatted == f"<|{r.role or ''}|>\n{r.content}\n" for r in found)


def test_odd_rows(frame):
    assert quotes.conversations(frame([], DDL)).collect() == []
    rows = [(1, 0, "user", "hello", 0, ""), (1, 0, "user", "hello", 0, ""), (1, 1, "user", "> Hello\nyes", 0, ""), (None, 1, "user", "> hello", 0, ""), (1, None, "x", "> hello\n", 0, "")]
    found = quotes.conversations(frame(rows, DDL))
    assert sorted(map(repr, (tuple(r)[:7] for r in found.collect()))) == sorted(map(repr, brute(rows)))
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().executedPlan().toString())
