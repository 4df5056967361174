"""Logs as they are written: one sequence per conversation, roles on ``open`` only, messages side by side, late edits."""

import hashlib
import random

from punctual.llm import chat

SCHEMA = "conv long, turn long, message string, seq long, kind string, role string, text string"


def told(log, learn="assistant"):
    """Every conversation replayed in its sequence."""
    state = {}
    for conv, turn, message, _, kind, role, text in sorted(log, key=lambda e: (e[0], e[3])):
        held = state.setdefault((conv, turn, message), ["", ""])
        if role is not None:
            held[0] = role
        if kind == "regenerate":
            held[1] = ""
        elif kind == "edit":
            held[1] = text or ""
        else:
            held[1] += text or ""
    out = {}
    for (conv, turn, message), (role, text) in sorted(state.items()):
        out.setdefault(conv, []).append((role, text))
    return {c: (len(m), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in m).encode()).hexdigest(), sum(len(t) for r, t in m if r == learn),
                hashlib.sha256("".join(t for r, t in m if r == learn).encode()).hexdigest()) for c, m in out.items()}


def logs(seed):
    rng = random.Random(seed)
    log = []
    for conv in range(6):
        seq, opened = 0, []
        for turn in range(rng.randrange(1, 7)):
            message = f"m{rng.randrange(10 ** 6)}"
            opened.append((turn, message))
            log.append((conv, turn, message, seq, "open", rng.choice(["user", "assistant"]), rng.choice(["", None, "x"])))
            seq += 1
            for _ in range(rng.randrange(6)):
                at, other = rng.choice(opened)  # any message so far
                kind = rng.choice(["delta", "delta", "delta", "edit", "regenerate"])
                log.append((conv, at, other, seq, kind, None, None if kind == "regenerate" else rng.choice(["ab", "<|im_end|>", "c\n", None])))
                seq += 1
    rng.shuffle(log)
    return log


def test_digests_replay_the_log(spark):
    for seed in (1, 2, 3):
        log = logs(seed)
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(spark.createDataFrame(log, SCHEMA).repartition(3)).collect()}
        assert got == told(log)


def test_role_on_open_only(spark):
    log = [(1, 0, "m", 0, "open", "assistant", None), (1, 0, "m", 1, "delta", None, "hello "), (1, 0, "m", 2, "delta", None, "world")]
    row = chat.format_messages(spark.createDataFrame(log, SCHEMA)).first()
    assert row.formatted == "<|im_start|>assistant\nhello world<|im_end|>\n" and row.formatted[row.loss_start:row.loss_end] == "hello world"


def test_the_derived_log_is_such_a_log(spark):
    turns = [(7, 0, "user", "q" * 450), (7, 1, "assistant", "a" * 700), (7, 2, "user", ""), (8, 0, "assistant", "z" * 250), (8, 0, "user", "same turn")]
    log = [tuple(r) for r in chat.event_log(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()]
    assert all((e[5] is not None) == (e[4] == "open") for e in log)
    sequence = [e[2] for e in sorted(log, key=lambda e: (e[0], e[3])) if e[0] == 7]
    assert len({e[3] for e in log if e[0] == 7}) == len(sequence) and sequence != sorted(sequence)
    assert {r.conv_id: r.turns_sha256 for r in chat.digests(spark.createDataFrame(log, SCHEMA)).collect()} == {c: t[1] for c, t in told(log).items()}
