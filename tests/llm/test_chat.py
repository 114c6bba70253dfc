import hashlib

import pytest

from millrace.llm import chat

CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "[TURN x]", "[/TURN]", "<\\s>", "[\\\\/INST]", "plain", "", "\\", "[", "é漢"]


@pytest.mark.parametrize("text", CONTROL + ["".join(CONTROL), "<</s>s>", "[[INST]INST]"])
def test_escape_comes_back(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(c in chat.escape(text) for c in ("<s>", "</s>", "[INST]", "[/INST]"))
    for role in ("user", "assistant", "system", "", "to]ol%5D", "[TURN "):
        assert chat.read_turn(chat.turn_template([(role, text)])) == (role, text)


def rows():
    out = [(1, 0, "system", "be brief"), (1, 1, "user", "[INST] hi"), (1, 2, "assistant", "yes</s>"), (1, 3, "assistant", "")]
    out += [(2, t, "user" if t % 2 == 0 else "assistant", f"turn {t} " * (t % 5)) for t in range(300)]
    return out + [(3, 1, None, None), (3, None, "assistant", "first"), (3, 1, None, None), (None, 0, "assistant", "x"), (4, 0, "assistant", " probe ")]


def expected(turns):
    out = {}
    for conv, turn, role, text in sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def test_digest(spark):
    turns = rows()
    df = spark.createDataFrame([(*r, "y", "z") for r in turns], "conv_id bigint, turn bigint, role string, text string, number string, conv_text string")
    got = {r["conv_id"]: r for r in chat.digest(chat.format_turns(df)).collect()}
    want = expected(turns)
    assert set(got) == set(want)
    for conv, said in want.items():
        learned = "".join(t for r, t in said if r == "assistant")
        assert got[conv]["n_turns"] == len(said)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(learned)
        assert got[conv]["formatted_chars"] == len(chat.turn_template(said))
        assert got[conv]["n_rewrites"] == 0
    assert chat.digest(chat.format_turns(df.limit(0))).count() == 0


def test_spans_are_the_whole_text(spark):
    turns = rows()
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    for conv, said in expected(turns).items():
        parts = [r for r in chat.format_turns(df).collect() if r["conv_id"] == conv]
        assert "".join(r["span"] for r in sorted(parts, key=lambda r: r["number"])) == chat.turn_template(said)


def last_turn_marked(turns):
    """Marks only the last turn, and so changes the ones before."""
    return "".join(f"({t})" if k < len(turns) - 1 else f"(({t}))" for k, (_, t) in enumerate(turns))


def numbered(turns):
    """Needs its whole prefix, but changes nothing."""
    return "".join(f"{k}:{r}:{t};" for k, (r, t) in enumerate(turns))


def test_a_template_that_rewrites_is_found():
    spans = chat.Spans(last_turn_marked)
    seen = [spans.add("user", f"t{k}") for k in range(40)]
    assert not seen[0][4] and all(s[4] for s in seen[1:])


def test_a_template_that_counts_keeps_its_prefix():
    spans = chat.Spans(numbered)
    text = "".join(spans.add("user", f"t{k}")[0] for k in range(60))
    assert text == numbered([("user", f"t{k}") for k in range(60)]) and spans.frozen


def test_a_template_that_moves_the_system_text(spark):
    def system_moved(turns):
        """Puts the system text in front of the last user turn only."""
        system = "".join(t for r, t in turns if r == "system")
        last = max((k for k, (r, _) in enumerate(turns) if r == "user"), default=-1)
        return "".join(f"<{r}>{system if k == last else ''}{t}" for k, (r, t) in enumerate(turns) if r != "system")

    said = [("system", "be brief"), *(("assistant" if k % 2 else "user", f"turn {k}") for k in range(40))]
    df = spark.createDataFrame([(1, k, r, t) for k, (r, t) in enumerate(said)], "conv_id bigint, turn bigint, role string, text string")
    rows = sorted(chat.format_turns(df, system_moved).collect(), key=lambda r: r["number"])
    made = ""
    for k, r in enumerate(rows):
        made = made[: r["start"]] + r["span"]
        assert made == system_moved(said[: k + 1])
        assert r["rewrites"] == (not made.startswith(system_moved(said[:k])))


def test_the_window_stays_short():
    longest = 0

    def template(turns):
        nonlocal longest
        longest = max(longest, len(turns))
        return chat.turn_template(turns)

    spans = chat.Spans(template)
    for k in range(500):
        spans.add("user", str(k))
    assert longest <= chat.WINDOW_TURNS + 2
