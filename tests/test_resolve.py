"""Input resolvers on real folders and payloads, with circles, all collection keys, both caps and clashing orders."""

import json

import pytest
from pyspark.sql import functions as F

from framelake.sources import resolve


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    top = tmp_path_factory.mktemp("tree")

    def put(path, text="x"):
        at = top / path
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text(text if isinstance(text, str) else json.dumps(text))

    for p in ("ep1/rgb.mp4", "ep1/other.mp4", "ep2/b.MOV", "ep2/a.mp4", "ep3/segments/s1/rgb.mp4", "ep3/segments/s2/cam_head.mp4", "ep3/rgb.mp4", "one/only.webm", "deep/x/y/z/video.mp4", "hidden/.h/rgb.mp4", "hidden/n.txt", "ep4/video.mp4", "ep4/cam_head.mp4"):
        put(p)
    put("loop/a.json", {"next": "b.json", "clips": []})
    put("loop/b.json", {"items": ["a.json", {"manifestPath": "../ep2/a.mp4"}]})
    put("manifests/m.json", {"clips": ["../ep1", {"clip_path": "../one/only.webm"}, "../ep2"], "videoPath": "../ep4"})
    put("manifests/empty.json", {"clips": ["nowhere.mp4"], "unknown": {"deeper": [{"who": "../ep1/other.mp4"}]}})
    put("manifests/broken.json", "{not json")
    put("jsons/inner/one.json", ["../../one/only.webm"])
    for i in range(520):
        put(f"many/j{i:04d}.json", [f"v{i}.mp4"] if i % 100 == 99 else [])
    put("far/v499.mp4")
    for i in (499, 519):
        put(f"many/sub/.keep{i}", "")
    return top


def abs_(root, *paths):
    return [str(root / p) for p in paths]


def cases(root):
    r = str(root)
    out = [
        ({"path": f"{r}/ep1"}, ["ep1/rgb.mp4"]),
        ({"path": f"{r}/ep2"}, ["ep2/a.mp4", "ep2/b.MOV"]),
        ({"path": f"{r}/ep3/segments"}, ["ep3/segments/s1/rgb.mp4", "ep3/segments/s2/cam_head.mp4"]),
        ({"data": {"videos": [f"{r}/ep3", f"{r}/ep3/segments"]}}, ["ep3/segments/s1/rgb.mp4", "ep3/segments/s2/cam_head.mp4"]),
        ({"path": f"{r}/loop/a.json"}, ["ep2/a.mp4"]),
        ({"dataRef": {"manifestPath": f"{r}/manifests/m.json"}}, ["ep1/rgb.mp4", "one/only.webm", "ep2/a.mp4", "ep2/b.MOV"]),
        ({"data": {"dataRef": {"payloadPath": f"{r}/manifests/empty.json"}}}, ["ep1/other.mp4"]),
        ({"path": f"{r}/manifests/broken.json"}, []),
        ({"path": "store://bucket/ep1", "data": f"{r}/one"}, ["one/only.webm"]),
        ({"path": f"{r}/hidden"}, []),
        ({"path": f"{r}/jsons"}, ["one/only.webm"]),
        ({"path": f"{r}/deep"}, []),
        # two of the known names side by side: each gives way to the other
        ({"data": [[f"{r}/ep4", [f"{r}/ep4/video.mp4"]], None, 3]}, []),
        ({"data": [[f"{r}/ep4"], None, 3, {"z": f"{r}/ep1/../ep4", "y": f"{r}//ep2/./a.mp4"}]}, ["ep4/cam_head.mp4", "ep2/a.mp4"]),
        ({"data": {"clipPath": "", "path": f"{r}/ep1/other.mp4", "zzz": f"{r}/ep2"}}, ["ep1/other.mp4"]),
        # the second object finds its file read already, and goes on to its next key
        ({"data": [{"clips": f"{r}/manifests/m.json"}, {"clips": f"{r}/manifests/m.json", "clip_path": f"{r}/ep4"}]}, ["ep1/rgb.mp4", "one/only.webm", "ep2/a.mp4", "ep2/b.MOV", "ep4/cam_head.mp4"]),
        ({}, []),
    ]
    out += [({"data": {k: [f"{r}/one"], "path": f"{r}/ep1"}}, ["one/only.webm"]) for k in resolve.COLLECTIONS]
    return out


def tables(spark, root, payloads):
    rows = [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "artifact long, payload string"), resolve.read_tree(spark, str(root))


def test_all_videos(spark, root):
    got = cases(root)
    artifacts, tree = tables(spark, root, [p for p, _ in got] + ["no json", "[1]"])
    found = {}
    for r in sorted(resolve.videos(artifacts, tree).collect(), key=lambda r: r.place):
        found.setdefault(r.artifact, []).append(r.path)
    assert found == {i: abs_(root, *want) for i, (_, want) in enumerate(got) if want}


def test_json_listings_are_capped(spark, root):
    many = root / "many"
    for i in (99, 199, 299, 399, 499):
        (many / f"v{i}.mp4").unlink(missing_ok=True)
    payload = {"path": str(many)}
    for i in (499, 519):
        far = root / "far" / f"v{i}.mp4"
        far.write_text("x")
        (many / f"j{i:04d}.json").write_text(json.dumps([str(far)]))
    artifacts, tree = tables(spark, root, [payload])
    assert [r.path for r in resolve.videos(artifacts, tree).collect()] == abs_(root, "far/v499.mp4")  # the 500th, not the 520th
    (many / "j0199.json").write_text(json.dumps([str(root / "one")]))
    (many / "j0200.json").write_text(json.dumps([str(root / "ep1")]))
    artifacts, tree = tables(spark, root, [payload])
    (r,) = resolve.runtime_input(artifacts, tree).collect()
    assert (r.kind, r.path) == ("video", str(root / "one/only.webm"))
    (many / "j0199.json").write_text("[]")
    artifacts, tree = tables(spark, root, [payload])
    (r,) = resolve.runtime_input(artifacts, tree).collect()
    assert r.kind is None and "path=" in r.error  # the 201st isn't read


def test_first_input(spark, root):
    r = str(root)
    got = [
        ({"path": f"{r}/ep1"}, ("episode", "ep1")),
        ({"path": f"{r}/ep2"}, None),
        ({"path": f"{r}/one"}, ("video", "one/only.webm")),
        ({"path": f"{r}/deep"}, ("episode", "deep/x/y/z")),
        ({"path": f"{r}/loop/a.json"}, ("video", "ep2/a.mp4")),
        ({"data": {"episodeDir": f"{r}/ep3", "video": f"{r}/missing.mp4"}}, ("episode", "ep3")),
        ({"data": {"metadata": {"a": [{"dir": f"{r}/ep4"}]}, "first": f"{r}/ep1"}}, ("episode", "ep4")),
        ({"dataRef": {"payloadPath": f"{r}/manifests/broken.json", "partitionDir": f"{r}/jsons"}}, ("video", "one/only.webm")),
        ({"path": "store://x", "dataRef": {"manifestPath": "gone"}}, None),
    ]
    artifacts, tree = tables(spark, root, [p for p, _ in got])
    rows = {x.artifact: x for x in resolve.runtime_input(artifacts, tree).collect()}
    assert {i: (x.kind, x.path) for i, x in rows.items() if x.kind} == {i: (w[0], str(root / w[1])) for i, (_, w) in enumerate(got) if w}
    assert "path=store://x [remote]" in rows[8].error and "dataRef.manifestPath=gone [missing, exists=False]" in rows[8].error and "dataRef.payloadPath=<empty>" in rows[8].error
    both = resolve.platform_inputs(*tables(spark, root, [{"path": f"{r}/ep2"}, {"path": f"{r}/deep"}, {"path": f"{r}/no"}])).collect()
    assert sorted((x.artifact, x.place, x.kind, x.path) for x in both if x.kind) == [(0, 0, "video", f"{r}/ep2/a.mp4"), (0, 1, "video", f"{r}/ep2/b.MOV"), (1, 0, "episode", f"{r}/deep/x/y/z")]
    assert [x.artifact for x in both if x.error] == [2]


def test_nothing_to_resolve(spark, root):
    artifacts, tree = tables(spark, root, [{}])
    assert resolve.videos(artifacts.limit(0), tree).count() == 0
    assert resolve.platform_inputs(artifacts, tree.limit(0)).count() == 1


def test_artifacts_are_decided_in_all_tasks(spark, root):
    """Few bytes are much work here: they aren't put together in one task, nor is there a call for each artifact."""
    artifacts, tree = tables(spark, root, [{"path": f"{root}/ep1"}] * 40)
    got = resolve.videos(artifacts, tree)
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert "CoGroups" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 40
