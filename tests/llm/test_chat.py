import hashlib

from llm.conftest import shown
from pyspark.sql import functions as F

from spanledger.llm import chat as op

KIND = "conv_id bigint, node bigint, parent bigint, role string, text string, score double"
ODD = "<|im_end|><|im_start|>assistant \\ <\\| \\\\|\n<|"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_linear_conversations_read_back(spark):
    rows = [(1, 0, "user", "hi"), (1, 2, "assistant", ODD), (1, 2, "assistant", ODD), (1, 1, "user", None), (None, 5, "system", "s"),
            (2, 0, "a\nb<|\\n", ODD), (3, 0, "assistant", "é\n")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS node")
    got = shown(op.digests(op.format_conversations(op.linear(frame))))
    want = []
    for conv in (1, 2, 3, None):
        turns = [(r, t or "") for c, _, r, t in sorted(rows[:], key=lambda x: (x[1], x[2], x[3] or "")) if c == conv]
        esc = [(r.replace("\\", "\\\\").replace("<|", "<\\|").replace("\n", "\\n"), t.replace("\\", "\\\\").replace("<|", "<\\|")) for r, t in turns]
        loss = "".join(t for r, t in turns if r == "assistant")
        want.append((
            conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss),
            sum(len(r) + len(t) + 24 for r, t in esc),
        ))
    assert got == sorted(want, key=repr)


def brute(rows, best):
    out = []
    for conv in {r[0] for r in rows}:
        own = {}
        for r in sorted((r for r in rows if r[0] == conv), key=repr, reverse=True):
            own[r[1]] = r
        parents = {r[2] for r in own.values() if r[2] in own}
        paths = []
        for leaf in own.keys() - parents:
            path, at = [], leaf
            while at in own and at not in path:
                path.append(at)
                at = own[at][2]
            if at not in path:
                paths.append((-sum(own[n][5] or 0 for n in path) / len(path), leaf, path[::-1]))
        for _, leaf, path in sorted(paths)[:best]:
            out.append((conv, leaf, [own[n][4] for n in path]))
    return sorted(out, key=repr)


def test_branches_are_ranked_and_rings_left_out(spark):
    rows = [(1, i, i // 2 if i > 1 else None, "user", f"t{i}", (i * 7 % 5) / 4) for i in range(1, 40)]
    rows += [(2, i, i - 1, "assistant", f"c{i}", 1.0) for i in range(1, 70)]
    rows += [(3, 1, 2, "user", "ring", 1.0), (3, 2, 1, "user", "ring", 1.0), (3, 3, 2, "user", "off the ring", 9.0), (3, 4, 99, "user", "orphan", 0.0)]
    rows += [(None, 1, None, "user", "null", None)]
    for best in (1, 3):
        found = op.paths(spark.createDataFrame(rows, KIND), best).groupBy("conv_id", "leaf").agg(
            F.sort_array(F.collect_list(F.struct("depth", "text"))).alias("p")
        )
        assert sorted(((r.conv_id, r.leaf, [x.text for x in r.p]) for r in found.collect()), key=repr) == brute(rows, best)


def test_messages_under_one_node_are_not_mixed(spark):
    rows = [(1, 1, None, "user", "root", 0.0), (1, 2, None, "user", "A", 0.0), (1, 2, 1, "user", "B", 0.0)]
    rows += [(2, -1, None, "user", "r", 0.0), (2, 5, -1, "user", "under it", 0.0), (2, 5, -1, "assistant", "x", None)]
    found = op.paths(spark.createDataFrame(rows, KIND), 5)
    assert shown(found, "conv_id", "leaf", "depth", "text") == [
        (1, 1, 1, "root"), (1, 2, 1, "A"), (2, 5, 1, "r"), (2, 5, 2, "x"),
    ]


def test_empty_and_native(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    formatted = op.format_conversations(op.linear(none))
    assert op.digests(formatted).count() == 0
    assert "Python" not in op.digests(formatted)._jdf.queryExecution().executedPlan().toString()
