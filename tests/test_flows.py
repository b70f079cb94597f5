"""Caption flows against a plain simulation, calls counted; batches as a data source."""

import json
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from framelake.functions import lenient, prompts
from framelake.operators import flows, inference
from framelake.sources import batches

BACKEND = inference.Scripted()
LABELS = ("household", "commercial", "industrial", "medical", "public_service", "education", "outdoor", "transportation", "entertainment", "unknown")


def said(custom_id, prompt, calls):
    calls[custom_id] += 1
    try:
        return BACKEND.reply(custom_id, prompt)
    except RuntimeError:
        return None


def fill(template, **places):
    return "".join(x if i % 2 == 0 else str(places[x]) for i, x in enumerate(template.parts))


def cut_windows(low, high, fps, sampling, whole=round):
    wide, step = max(1, whole(sampling.window * fps)), max(1, whole(sampling.step * fps))
    out, s = [], low
    while True:
        e = min(s + wide, high) - 1
        k = sampling.frames if whole is int and high - low <= wide else min(sampling.frames, e - s + 1)
        out.append((s, e, [s + math.floor(i * ((e - s) / (k - 1))) if i < k - 1 else e for i in range(k)] if k > 1 else [s]))
        if e == high - 1 or high - low <= wide:
            return out
        s += step


def ask_windows(windows, fps, template, name, field, calls, fenced=False, **places):
    got = []
    for i, (s, e, ids) in enumerate(windows):
        text = said(name(i), fill(template, n=len(set(ids)), start=f"{s / fps:.1f}", end=f"{e / fps:.1f}", **places), calls)
        value = lenient.first_object(text) if fenced else json.loads(m[0]) if (m := re.search(r"\{.*\}", text or "", re.S)) else None
        got.append(None if value is None else ([int(t) for t in value["transitions"]], value[field]))
    return got


def weights(n):
    return [1.0] if n == 1 else [0.5 - 0.5 * math.cos(2 * math.pi * (i + 1) / (n + 1)) for i in range(n)]


def gather(windows, answers):
    cuts, spans, line = [], [], {}
    for i, ((_, _, ids), got) in enumerate(zip(windows, answers)):
        if got is None:
            continue
        places = [t for t in got[0] if 0 <= t < len(ids)]
        cuts += [(ids[t], weights(len(windows))[i]) for t in places]
        ends = [0, *places, len(ids) - 1]
        for j, what in enumerate(got[1][: len(ends) - 1]):
            spans.append((ids[ends[j]], ids[ends[j + 1]], what))
            for k in range(ends[j], ends[j + 1] + 1):
                line.setdefault(ids[k], []).append(what)
    return sorted(cuts, key=lambda c: c[0]), spans, line


def centres(cuts, radius, first):
    groups = []
    for c in cuts:
        if groups and c[0] - groups[-1][0 if first else -1][0] <= radius:
            groups[-1].append(c)
        else:
            groups.append([c])
    return [int(round(sum(f * w for f, w in g) / sum(w for _, w in g), 9)) for g in groups]


def greedy(points, low, high, least):
    kept = [low]
    for p in sorted(set(points)):
        if p - kept[-1] >= least:
            kept.append(p)
    if high - kept[-1] < least and len(kept) > 1:
        kept.pop()
    return list(zip(kept, [*kept[1:], high]))


def most(values):
    return Counter(values).most_common(1)[0][0] if values else None


def chained(windows, answers, low, high, fps, default):
    cuts, _, line = gather(windows, answers)
    if not cuts:
        return [(low, high, default)]
    key = lambda x: json.dumps(x, sort_keys=True)
    points = [c for c in centres(cuts, max(1, int(2.0 * fps)), False) if low < c < high]
    out = []
    for s, e in greedy(points, low, high, max(1, int(0.8 * fps))):
        votes = [key(x) for f in range(s + int(0.4 * (e - s)), s + int(0.6 * (e - s)) + 1) for x in line.get(f, [])] or [key(x) for f in range(s, e) for x in line.get(f, [])]
        what = (json.loads(most(votes)) if votes else None) or default
        if out and key(out[-1][2]) == key(what):
            out[-1] = (out[-1][0], e, what)
        else:
            out.append((s, e, what))
    return out


def anchored(windows, answers, n, fps, alone, spare, marks=None, snap=45):
    cuts, spans, _ = gather(windows, answers)
    if not cuts:
        return [(0, n, spans[0][2] if spans else alone)]
    points = centres(cuts, int(2.0 * fps), True)
    if marks:
        near = [min((abs(m - p), m) for m in marks) for p in points]
        points = [m if d <= snap else p for (d, m), p in zip(near, points)]
    out = []
    for i, (s, e) in enumerate(greedy(points, 0, n, int(0.8 * fps))):
        a, b = s + int(0.4 * (e - s)), s + int(0.6 * (e - s))
        what = most([x for u, v, x in spans if u <= b and v >= a])
        out.append((s, e, what if what is not None else spare(i)))
    return out


def scene(episode, n, fps, calls):
    text = said(f"{episode}/scene", fill(prompts.SCENE, n=min(16, n), seconds=f"{n / fps:.1f}"), calls)
    m = re.search(r"\{.*\}", text or "", re.S)
    label = json.loads(m[0])["scene"].strip().lower() if m else "unknown"
    return label if label in LABELS else "unknown"


def listing(segments):
    return json.dumps([{"seg_id": i, "frame_interval": [s, e], "instruction": x} for i, (s, e, x) in enumerate(segments)], separators=(",", ":"), ensure_ascii=False)


def sound(old, text, steps):
    m = re.search(r"\[.*\]", text or "", re.S)
    new = json.loads(m[0]) if m else []
    bounds = {x for s, e, _ in old for x in (s, e)}
    spans = [tuple(x["frame_interval"]) for x in new]
    ok = bool(new) and all(x in bounds for s in spans for x in s) and spans[0][0] == old[0][0] and spans[-1][1] == old[-1][1] and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    if ok and steps:
        numbers = [x["sop_step_index"] for x in new]
        ok = numbers == sorted(numbers)
    return new if ok else None


DEFAULT = "perform the current task"


def two_level(episode, n, fps, calls):
    w = cut_windows(0, n, fps, flows.TASKS)
    raw = chained(w, ask_windows(w, fps, prompts.TASKS, lambda i: f"{episode}/task_{i}", "tasks", calls), 0, n, fps, {"instruction": DEFAULT})
    label = scene(episode, n, fps, calls)
    segs = [(s, e, x.get("instruction", "")) for s, e, x in raw]
    how = "kept"
    if len(segs) > 1:
        new = sound(segs, said(f"{episode}/refine_tasks", fill(prompts.MERGE_TASKS, segments=listing([(s, e, x.strip() or DEFAULT) for s, e, x in segs])), calls), False)
        if new:
            segs, how = [(*x["frame_interval"], x["instruction"].strip() or DEFAULT) for x in new], "refined"
        else:
            out = []
            for s, e, x in segs:
                if out and x.strip() and out[-1][2].strip().lower() == x.strip().lower():
                    out[-1] = (out[-1][0], e, out[-1][2])
                else:
                    out.append((s, e, x))
            segs, how = out, "merged"
    segs = [(s, e, (x or DEFAULT).strip()) for s, e, x in segs]
    words = "; ".join(x for *_, x in segs if x) or DEFAULT
    rows = []
    for t, (s, e, x) in enumerate(segs):
        w = cut_windows(s, e, fps, flows.ACTIONS)
        acts = chained(w, ask_windows(w, fps, prompts.ACTIONS, lambda i: f"{episode}/action_{t}_{i}", "actions", calls, task=x), s, e, fps, "act")
        acts = [(re.sub("[^a-z0-9]+", "_", a.strip().lower()).strip("_") or "act", u, v) for u, v, a in acts]
        rows.append((episode, label, words, t, s, e, x, how, acts))
    return rows


@pytest.fixture(scope="module")
def episodes(spark):
    rows = [(i, n, f) for i, (n, f) in enumerate([(1, 30.0), (40, 10.0), (95, 10.0), (900, 10.0), (1500, 9.99), (2400, 7.53), (3000, 25.0), (1200, 10.0), (700, 5.0), *((2000 + 90 * k, 10.0) for k in range(8))])]
    return spark.createDataFrame(rows + [(99, 0, 10.0)], "episode long, n long, fps double")


def every(episodes):
    return [(r.episode, r.n, r.fps) for r in episodes.collect() if r.n > 0]


def counting(path):
    """A backend that notes each call as a file's line; local, so that workers need not import this module."""

    class Counting(inference.Scripted):
        def reply(self, custom_id, prompt):
            with open(path, "a") as f:
                f.write(custom_id + "\n")
            return super().reply(custom_id, prompt)

    return Counting


def counted(path):
    return Counter(path.read_text().split())


@pytest.mark.parametrize("by_batch", [False, True])
def test_two_level_captions(spark, episodes, tmp_path, by_batch):
    log = tmp_path / "calls"
    make = counting(str(log))
    ask = batches.ask(batches.Spool(f"file://{tmp_path}/spool", make, waits=2), make, interval=0.01) if by_batch else batches.ask(None, make)
    got = flows.two_level_captions(episodes, ask)
    calls = Counter()
    want = sorted(x for e in every(episodes) for x in two_level(*e, calls))
    rows = sorted((r.episode, r.scene, r.instruction, r.task, r.s, r.e, r.caption, r.how, [tuple(a) for a in r.actions]) for r in got.collect())
    assert rows == want
    assert len({r[7] for r in rows}) == 3  # kept, refined and merged all occur
    assert counted(log) == calls and set(calls.values()) == {1}


def test_task_captions(spark, episodes, tmp_path):
    log = tmp_path / "calls"
    got = flows.task_captions(episodes, batches.ask(None, counting(str(log)))).collect()
    calls, want = Counter(), []
    for e, n, fps in every(episodes):
        w = cut_windows(0, n, fps, flows.STEPS)
        answers = ask_windows(w, fps, prompts.STEPS, lambda i: f"{e}/win_{i}", "instructions", calls, True, task="")
        label = scene(e, n, fps, calls)
        if all(a is None for a in answers):
            want.append((e, label, None, None, None, "error"))
        else:
            want += [(e, label, s, t, x, "ok") for s, t, x in anchored(w, answers, n, fps, "Full video", lambda i: f"Step {i + 1}")]
    assert sorted(((r.episode, r.scene, r.s, r.e, r.caption if r.status == "ok" else None, r.status) for r in got), key=repr) == sorted(want, key=repr)
    assert counted(log) == calls and set(calls.values()) == {1}
    for r in got:
        assert r.status == "ok" or r.caption.startswith("no answer of ")


def test_sop_captions_ask_again_only_where_rules_are_broken(spark, episodes, tmp_path):
    log = tmp_path / "calls"
    steps = [(1, "open it"), (2, "pour"), (3, "close it")]
    work = [e for e in every(episodes) if e[0] != 2]
    sops = spark.createDataFrame([(e, "pouring", steps) for e, _, _ in work], "episode long, task_name string, steps array<struct<step:int,description:string>>")
    marks = {e: [k for k in range(0, n, 37) if k % 3] for e, n, _ in work}
    valleys = spark.createDataFrame([(e, m) for e, v in marks.items() for m in v], "episode long, mark long")
    got = flows.sop_captions(episodes, sops, valleys, batches.ask(None, counting(str(log)))).collect()
    calls, want = Counter(), []
    text = "\n".join(f"  Step {i}: {x}" for i, x in steps)
    for e, n, fps in work:
        w = cut_windows(0, n, fps, flows.STEPS, int)
        answers = ask_windows(w, fps, prompts.SOP_STEPS, lambda i: f"{e}/desc_win_{i}", "instructions", calls, task="pouring", steps=text)
        segs = anchored(w, answers, n, fps, "pouring", lambda i: steps[min(i + 1, 3) - 1][1], marks[e])
        label, prompt = scene(e, n, fps, calls), fill(prompts.MERGE_STEPS, task="pouring", steps=text, segments=listing(segs))
        for k in (1, 2, 3):
            new = sound(segs, said(f"{e}/refine_{k}", prompt, calls), True)
            if new:
                want += [(e, label, i, *x["frame_interval"], x["instruction"], x["sop_step_index"], k, "refined") for i, x in enumerate(new)]
                break
        else:
            out = []
            for s, t, x in segs:
                out[-1:] = [(out[-1][0], t, x)] if out and out[-1][2] == x else [*out[-1:], (s, t, x)]
            want += [(e, label, i, s, t, x, i + 1, 3, "merged") for i, (s, t, x) in enumerate(out)]
    assert sorted((r.episode, r.scene, r.step, r.s, r.e, r.instruction, r.sop_step_index, r.attempts, r.how) for r in got) == sorted(want)
    assert {r.attempts for r in got} >= {1, 2} and counted(log) == calls and set(calls.values()) == {1}


def test_batches_survive_their_session(spark, tmp_path):
    requests = spark.createDataFrame([(f"c{i}", f'say "instructions" {i}') for i in range(90)], "custom_id string, prompt string").repartition(4)
    for chat in (True, False):
        asker = batches.Batches(batches.Spool(f"file://{tmp_path}/{chat}", inference.Scripted, waits=3, chat=chat), interval=0.01)
        token = asker.submit(requests)
        assert asker.state(spark, token)["batch"]
        later = batches.Batches(asker.provider, interval=0.01)  # as another session would
        got = {r.custom_id: (r.text, r.status_code) for r in later.collect(spark, token).collect()}
        direct = {r.custom_id: (r.text, r.status_code) for r in inference.call(requests, inference.Scripted).collect()}
        assert got == direct and {s for _, s in got.values()} == {200, 500}
        later.clear(spark, token)
        later.clear(spark, token)
        assert later.state(spark, token) is None


def test_batches_are_held_in_parts(tmp_path):
    import tracemalloc

    from pyspark.sql import Row

    n, record = 20_000, str(tmp_path / "record")
    spool = batches.Spool(f"file://{tmp_path}/spool", inference.Scripted, waits=0)
    made = batches.source(spool)({"record": f"file://{record}", "interval": "0"})
    rows = (Row(value=json.dumps({"custom_id": str(i), "messages": [{"role": "user", "content": "what " * 60}]})) for i in range(n))
    writer, held = made.writer(None, False), []
    for step in ("write", "read"):
        tracemalloc.start()
        if step == "write":
            writer.commit([writer.write(rows)])
        else:
            reader = made.reader(None)
            assert sum(len(b) for p in reader.partitions() for b in reader.read(p)) == n
        held.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert max(held) < 3_000_000  # the requests are over 7 MB


def test_batches_that_do_not_complete(spark, tmp_path):
    requests = spark.createDataFrame([("a", "b")], "custom_id string, prompt string")
    for status in ("failed", "expired", "cancelled"):
        with pytest.raises(Exception, match=f"(?s)ended as {status}"):
            batches.Batches(batches.Spool(f"file://{tmp_path}/{status}", inference.Scripted, status=status), interval=0.01)(requests).collect()
    slow = batches.Batches(batches.Spool(f"file://{tmp_path}/slow", inference.Scripted, waits=10**6), interval=0.01, options={"patience": "0.1"})
    with pytest.raises(Exception, match="(?s)is still in_progress"):
        slow(requests).collect()
    none = batches.Batches(batches.Spool(f"file://{tmp_path}/none", inference.Scripted), interval=0.01)
    assert none(requests.limit(0)).count() == 0


def test_provider_without_batches_is_asked_at_once(spark):
    asker = batches.ask(batches.Spool("file:///nowhere", inference.Scripted, batch=False), inference.Scripted)
    assert isinstance(asker, inference.Direct)
    assert asker(spark.createDataFrame([("a", 'x "actions"')], "custom_id string, prompt string")).count() == 1


def test_answers_of_odd_shapes(spark):
    texts = ['{"transitions": [1, 2.9, "3", true, null, -1, 99], "tasks": [{"b": 1, "instruction": "x", "a": 2}, "plain", 5]}', '{"transitions": "12", "tasks": "no list"}', '[1, 2]', 'prose {broken', '{"tasks": [null, {}]}', None]
    windows = spark.createDataFrame([(i, f"c{i}", "p") for i in range(len(texts) + 1)], "k long, custom_id string, prompt string")
    answers = spark.createDataFrame([(f"c{i}", t) for i, t in enumerate(texts)], "custom_id string, text string")
    got = {r.k: (r.transitions, r.payloads) for r in flows.read_windows(windows, answers, "tasks").collect()}
    assert got[0] == ([1, 2, 1, -1, 99], ['{"a":2,"b":1,"instruction":"x"}', "plain", "5"])
    assert got[1] == ([], []) and got[4] == ([], ["null", "{}"])
    assert got[2] == got[3] == got[5] == got[6] == (None, [])


def test_overlaps_meet_once(spark):
    from framelake.functions.ranges import nearest, overlaps

    a = [(k, s, s + d) for k in range(2) for s, d in ((0, 5), (3, 40), (10, 0), (25, 3), (30, -4))]
    b = [(k, s, s + d) for k in range(2) for s, d in ((0, 0), (4, 9), (11, 30), (60, 2), (13, -3))]
    got = overlaps(spark.createDataFrame(a, "k int, s long, e long"), spark.createDataFrame(b, "k int, u long, v long"), ["k"], ("s", "e"), ("u", "v"), 8)
    assert sorted(tuple(r) for r in got.select("k", "s", "e", "u", "v").collect()) == sorted((k, s, e, u, v) for k, s, e in a for j, u, v in b if j == k and s <= v and e >= u)
    points, marks = [(1, p) for p in (0, 5, 9, 50)], [(1, m) for m in (2, 8, 10, 41)]
    near = nearest(spark.createDataFrame(points, "k int, at long"), spark.createDataFrame(marks, "k int, mark long"), ["k"], "at", "mark", 3)
    assert {r.at: r.mark for r in near.collect()} == {0: 2, 5: 2, 9: 8, 50: None}
