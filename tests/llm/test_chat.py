import hashlib

import pytest

from ledgerline.llm import chat

TEXT = 'a & b &lt; [INST] <s>[user] </s> é😀 &amp; ]]'
ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
    (2, 0, "system", "be kind"), (2, 1, "user", "hi"), (2, 2, "assistant", "good day"),
    (2, 3, "user", TEXT), (2, 4, "assistant", TEXT),
    (3, 0, "system", "be kind"), (3, 1, "user", "hi"), (3, 2, "assistant", "hello"),  # as 1
    (4, 0, "user", None), (4, 1, "assistant", ""), (5, 7, None, "no role"), (5, 3, "assistant", "first"),
    (6, 1, "b", "tie"), (6, 1, "a", "tie"), (6, None, "user", "no turn"), (None, 0, "user", "no id"),
    (7, 0, "assistant", "x" * 20000), (8, 0, "user", "be kind"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def turns(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    return frame.selectExpr("*", "'x' AS node", "1 AS path", "2 AS depth")  # clashing names


@pytest.fixture(scope="module")
def formatted(turns):
    found, nodes = chat.format_conversations(turns)
    return found, nodes, sorted(nodes.collect(), key=lambda n: (n["part"], n["offset"]))


def above(n, nodes):
    """The nodes that lie in the ancestor intervals of ``n``, in their order."""
    return [x for a in n["ancestors"] for x in nodes
            if x["part"] == a["part"] and a["from"] <= x["offset"] < a["to"]]


def conversations():
    out = {}
    for c, t, role, text in sorted(ROWS, key=lambda r: (r[0] or -1, r[1] is not None, r[1] or 0,
                                                        r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def test_turns_and_loss_come_back(formatted):
    found, nodes, _ = formatted
    got = {r["conv_id"]: r for r in chat.digests(chat.read_back(found, nodes)).collect()}
    for c, turns in conversations().items():
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got.pop(c)
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(loss))
        assert r["attended_chars"] == r["formatted_chars"] > 0
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert not got


def test_shared_turns_are_stored_once_and_depth_first(formatted):
    _, _, nodes = formatted
    prefixes = {tuple(t[:k + 1]) for t in conversations().values() for k in range(len(t))}
    assert len(nodes) == len(prefixes)
    assert sum(n["conversations"] for n in nodes) == len(ROWS)
    names = [n["node"] for n in nodes]
    assert len(set(names)) == len(names)
    # A child follows its parent with only other descendants of the parent between them.
    at = {n["node"]: k for k, n in enumerate(nodes)}
    for n in nodes:
        for up in above(n, nodes):
            between = nodes[at[up["node"]] + 1:at[n["node"]]]
            assert all(up in above(b, nodes) for b in between)


def test_positions_ancestors_and_loss_spans(formatted):
    _, _, nodes = formatted
    for n in nodes:
        up = above(n, nodes)
        assert [x["depth"] for x in up] == list(range(1, n["depth"]))
        assert n["size"] == len(n["segment"])
        assert n["position"] == sum(x["size"] for x in up) \
            == sum(a["to"] - a["from"] for a in n["ancestors"])
        for a, b in zip(n["ancestors"], n["ancestors"][1:]):  # as few intervals as can be
            assert (a["part"], a["to"]) != (b["part"], b["from"])
    part = {}
    for n in nodes:  # gapless in each partition
        assert n["offset"] == part.get(n["part"], 0)
        part[n["part"]] = n["offset"] + n["size"]


def test_no_control_string_inside_texts(formatted):
    _, _, nodes = formatted
    for n in nodes:
        assert n["segment"].count("<s>") == 1 and n["segment"].count("</s>") == 1
        assert n["segment"].count("[") == 1 and n["segment"].count("]") == 1


def test_a_long_path_over_many_parts_has_few_intervals(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (1, 2) for t in range(200)]
    rows += [(2, 200, "user", "more"), (3, 0, "user", "turn 0"), (3, 1, "assistant", "else")]
    found, nodes = chat.format_conversations(spark.createDataFrame(rows, SCHEMA))
    nodes = sorted(nodes.collect(), key=lambda n: (n["part"], n["offset"]))
    assert len(nodes) == 202 and len({n["part"] for n in nodes}) > 2
    for n in nodes:
        assert [x["depth"] for x in above(n, nodes)] == list(range(1, n["depth"]))
        assert len(n["ancestors"]) <= 10


def test_empty_table(spark):
    found, nodes = chat.format_conversations(spark.createDataFrame([], SCHEMA))
    assert nodes.count() == 0 and chat.read_back(found, nodes).count() == 0
