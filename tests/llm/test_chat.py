import hashlib

from pyspark.sql import functions as F

from quillgrid.llm.chat import as_log, chat_format, op6_chat_formatting, read_back, reconstruct

from .common import as_table

EVENTS = "conv_id long, seq long, kind string, message_id string, role string, text string"


def fold(events):
    """The plain reading of a log, one conversation."""
    events = sorted(events, key=lambda e: (e[1] is not None, e[1] or 0, e[2] or "message", e[4] or "", e[5] or "", e[3] or ""))
    messages, order = {}, []
    for n, (_, _, kind, mid, role, text) in enumerate(events):
        kind = kind or "message"
        if kind not in ("start", "delta", "delete", "message", "edit", "regenerate"):
            continue
        key = mid if mid is not None else n
        if key not in messages:
            messages[key] = {"role": "", "text": "", "gone": False}
            order.append(key)
        m = messages[key]
        m["role"] = m["role"] or role or ""
        if kind in ("message", "edit", "regenerate"):
            m |= {"text": text or "", "gone": False}
        elif kind == "delta":
            m["text"] += text or ""
        elif kind == "delete":
            m["gone"] = True
    return [(messages[k]["role"], messages[k]["text"]) for k in order if not messages[k]["gone"]]


LOG = [
    (1, 1, "start", "a", "user", None),
    (1, 2, "delta", "a", None, "He"),
    (1, 3, "delta", "a", None, "llo"),
    (1, 4, "start", "b", "assistant", None),
    (1, 5, "delta", "b", None, "wrong"),
    (1, 6, "regenerate", "b", None, None),
    (1, 7, "delta", "b", None, "right <turn user>\n"),
    (1, 8, "edit", "a", None, "Hi \\e\\\\l"),
    (1, 9, "message", "c", "user", "gone"),
    (1, 10, "delete", "c", None, None),
    (1, 11, "delete", "d", "user", None),
    (1, 12, "message", "d", "user", "back"),
    (1, 12, "message", None, "user", "tie"),
    (1, 12, "message", None, "user", "tie"),
    (1, 13, "unknown", None, "user", "no"),
    (1, None, None, None, None, None),
    (1, 14, "message", None, "assistant", "</turn>\n"),
    (1, 15, "message", None, "a>b<c", "odd role"),
]


def test_fold_and_round_trip(spark):
    frame = spark.createDataFrame([*LOG, (None, 1, "message", None, "user", "no id")], EVENTS)
    want = fold(LOG)
    got = [(r.role, r.text) for r in reconstruct(frame).filter("conv_id = 1").orderBy("position").collect()]
    assert got == want
    back = {r.conv_id: r for r in read_back(chat_format(frame)).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == want
    assert list(back[1].learned) == [t for r, t in want if r == "assistant"]
    assert back[None].turns[0].text == "no id"


def test_the_query_s_log_goes_through_edits_regenerations_and_deltas(spark):
    rows = [(1, 0, "user", "Hello"), (1, 1, "assistant", "wörld"), (1, 1, "assistant", "wörld"), (1, None, "assistant", "first"), (1, None, None, None), (1, 1, "user", "b"), (1, 1, "assistant", "a")]
    log = as_log(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS n", "2 AS log", "'x' AS kind"))
    assert {r.kind: r.n for r in log.groupBy("kind").agg(F.count("*").alias("n")).collect()} == {"message": 7, "delta": 14, "edit": 3, "regenerate": 4}
    want = sorted(((t is not None, t or 0, r or "", x or "") for _, t, r, x in rows))
    got = [(r.role, r.text) for r in reconstruct(log.selectExpr("*", "3 AS position", "4 AS own")).orderBy("position").collect()]
    assert got == [(r, x) for *_, r, x in want]
    without = [(r.role, r.text) for r in reconstruct(log.filter("kind NOT IN ('edit', 'regenerate')")).collect()]
    assert all(x.count("(goes on)") == 1 for _, x in without)


def test_empty_log(spark):
    assert chat_format(spark.createDataFrame([], EVENTS)).count() == 0


def test_query(spark, tmp_path):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "é<>\\"), (2, 0, None, ""), (2, 0, None, ""), (1, 2, "assistant", "x" * 50_000)]
    d = as_table(spark, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), tmp_path, "conversations")
    got = {r.conv_id: r for r in op6_chat_formatting(spark, d).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\n\nassistant\né<>\\\nassistant\n" + "x" * 50_000 + "\n")
    assert got[1].loss_sha256 == sha("é<>\\" + "x" * 50_000) and got[1].loss_chars == 50_004
    assert got[2].n_turns == 2 and got[2].loss_sha256 == sha("")
    said = "\\### Assistant: </turn> ok"
    assert got[-7].loss_sha256 == sha(said) and got[-7].turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\n")
