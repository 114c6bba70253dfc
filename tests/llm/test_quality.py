import random
import re
from collections import Counter

from millrace.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    words = lambda t: WORD.findall(t or "")
    hosts, seen = Counter(host for host, _ in {(r[3] or "", r[1] or "") for r in rows}), {}
    for _, t, _, host in rows:
        for line in (t or "").split("\n"):
            if words(line):
                seen.setdefault((host or "", tuple(words(line))), set()).add(t or "")
    often = {k for k, v in seen.items() if len(v) > 10 and len(v) > 0.01 * hosts[k[0]]}
    out = []
    for i, t, _, host in rows:
        t, ws = t or "", words(t)
        lines = [x for x in t.split("\n") if words(x)]
        three = list(zip(ws, ws[1:], ws[2:], strict=False))
        twice = {g for g, n in Counter(three).items() if n > 1}
        repeat = len({k + d for k, g in enumerate(three) if g in twice for d in range(3)})
        failed = len(ws) < 50 or 100 * repeat > 50 * len(ws)
        cut = 0 if failed else sum(len(words(x)) for x in lines if (host or "", tuple(words(x))) in often)
        out.append((i, len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeat, failed, not failed and 100 * cut <= 70 * len(ws), cut))
    return Counter(out)


def corpus():
    draw = random.Random(8)
    vocabulary = [f"w{k}#" if k % 50 == 0 else f"ü{k}" for k in range(400)]
    line = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    footer, menu = line(9), [line(12) for _ in range(8)]
    rows = []
    for i in range(120):
        host = f"h{i % 3}" if i % 10 else None
        body = [line(draw.randint(1, 14)) for _ in range(draw.randint(1, 12))]
        if i % 2:
            body.insert(draw.randrange(len(body)), footer.replace(" ", "  "))
        if i % 7 == 0:
            body = [*menu, line(3)]
        if i % 11 == 0:
            body += body
        rows.append((i, "\n".join(body), None, host))
    return rows + [(1000 + i, "\n".join(menu[:6]) + f"\nown words {i}", None, "h1") for i in range(30)]


def judged(df):
    return Counter(map(tuple, quality.judge(df).collect()))


def test_judge(documents):
    rows = corpus()
    want = brute(rows)
    assert judged(documents(rows)) == want
    assert any(not r[7] and not r[6] for r in want) and any(r[7] for r in want)


def test_odd_rows(documents, odd_rows):
    rows = [(i, t, None, None) for i, t in odd_rows]
    assert judged(documents(rows)) == brute(rows)
    assert quality.judge(documents([])).count() == 0 and quality.clean(documents([])).count() == 0


def test_clean(documents):
    rows = corpus()
    docs = documents(rows)
    got = quality.clean(docs)
    assert got.dtypes == docs.dtypes
    kept = {r[0]: r for r in brute(rows) if r[7]}
    texts = {r["doc_id"]: r for r in got.collect()}
    assert set(texts) == set(kept)
    for i, t, _, _ in rows:
        if i in kept:
            left = WORD.findall(texts[i]["text"])
            assert len(left) == kept[i][1] - kept[i][8]
            assert (texts[i]["text"] == t) == (kept[i][8] == 0)
            assert texts[i]["n_chars"] == len(texts[i]["text"])


def test_copies_of_a_text_do_not_deplete_it(documents):
    draw = random.Random(3)
    text = "\n".join(" ".join(f"v{draw.randrange(900)}" for _ in range(9)) for _ in range(9))
    got = quality.judge(documents([(i, text, None, "h") for i in range(60)])).collect()
    assert all(r["kept"] and r["cut_words"] == 0 for r in got)


def test_words_with_equal_polynomials(documents):
    x = "".join("in"[bin(k).count("1") % 2] for k in range(2048))
    y = x.translate({ord("i"): "n", ord("n"): "i"})
    rows = [(0, f"{x}\n{y}"), (1, f"a b {x} c {y} a b {y} c {x}"), (2, f"{x} {y} z {y} {x} z")]
    rows = [(*r, None, None) for r in rows]
    assert judged(documents(rows)) == brute(rows)


def test_limit_of_a_large_host(documents):
    # 3,000 rows of 1,500 different texts: one in a hundred of the texts, not of the rows, is the limit
    draw = random.Random(2)
    rows = []
    for i in range(1500):
        text = "\n".join([" ".join(draw.choice("abcdefgh") * draw.randint(1, 9) for _ in range(60)), *(["in some texts"] if i < 18 else []), *(["in few texts"] if i < 12 else []), f"own {i}"])
        rows += [(2 * i, text, None, "hot"), (2 * i + 1, text, None, "hot")]
    docs = documents(rows)
    assert judged(docs) == brute(rows)
    assert quality.judge(docs).filter("cut_words > 0").count() == 36
