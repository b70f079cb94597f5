"""The engine's queries: an operator's SQL over a dialect, and the views it reads."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from framelake.operators import answers as A
from framelake.operators import captions as C
from framelake.operators import chains as N
from framelake.operators import media as M
from framelake.operators import paths as P
from framelake.operators import privacy as B
from framelake.operators import quality as Q
from framelake.operators import sampling as S
from framelake.operators import segmentation as G
from framelake.operators import votes as W
from framelake.plans import flows as L
from framelake.plans import inputs as I
from framelake.plans import media as V
from framelake.plans import reports as R
from framelake.plans import runs as U
from framelake.plans.dialect import DUCK, SPARK, Spark
from framelake.sources import fixtures as X


def table(name: str) -> Callable[[Spark], str]:
    return lambda d: f"SELECT * FROM {name}"


def cached(d: Spark) -> str:
    """Frames already materialised: two of three."""
    return f"SELECT episode, frame_idx FROM ({X.frames(d)}) f WHERE frame_idx % 3 <> 0"


def counted(text: str) -> str:
    """count_if(x) as a filtered count, which is a long in the oracle's engine."""
    while (i := text.find("count_if(")) >= 0:
        j, deep = i + len("count_if("), 1
        while deep:
            deep += {"(": 1, ")": -1}.get(text[j], 0)
            j += 1
        text = f"{text[:i]}count(*) FILTER (WHERE {text[i + len('count_if('):j - 1]}){text[j:]}"
    return text


@dataclass(frozen=True)
class Operator:
    sql: Callable[[Spark], str]
    views: dict[str, Callable[[Spark], str]] = field(default_factory=dict)

    def over(self, **views: DataFrame) -> DataFrame:
        """The operator over DataFrames of its own."""
        return next(iter(views.values())).sparkSession.sql(self.sql(SPARK), **views)

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.over(**{name: X.load(spark, sf_dir, view) for name, view in self.views.items()})

    def oracle(self) -> str:
        text = counted(self.sql(DUCK))
        for name in self.views:
            text = text.replace(f"{{{name}}}", f"{name}_view")
        ctes = ", ".join(f"{name}_view AS ({view(DUCK)})" for name, view in self.views.items())
        return f"WITH {ctes} {text}".replace("{{", "{").replace("}}", "}")


@dataclass(frozen=True)
class Query:
    """A query of DataFrame functions, with an oracle written on its own."""

    build: Callable[..., DataFrame]
    sql: str
    views: dict[str, Callable[[Spark], str]]

    over = property(lambda self: self.build)

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(**{name: X.load(spark, sf_dir, view) for name, view in self.views.items()})

    def oracle(self) -> str:
        return self.sql


GRAY, FRAMES, EPISODES, BOXES = {"frames": X.gray}, {"frames": X.frames}, {"episodes": X.episodes}, {"boxes": X.boxes}
ASK, TREE, MEDIA = {"requests": X.requests, "responses": X.responses}, {"tasks": X.tasks, "actions": X.actions}, {"probes": X.probes, "specs": X.specs}

OPERATORS: dict[str, Operator | Query] = {
    # frames of 8 x 8 pixels are sharper than real ones
    **{f.__name__: Operator(partial(f, blur=12000.0), GRAY) for f in (Q.frame_quality, Q.quality_summary, Q.quality_verdict, Q.flagged_frames)},
    **{f.__name__: Operator(f, GRAY) for f in (Q.frame_exposure, Q.exposure_summary, Q.pair_motion, Q.stability_summary)},
    **{f.__name__: Operator(f, EPISODES) for f in (S.sample_windows, S.window_frames, S.stride_frames, S.fps_frames, S.uniform_frames, S.frame_demand)},
    "legacy_windows": Operator(lambda d: S.sample_windows(d, truncate=True, window_sec=0.45), EPISODES),
    "range_windows": Operator(lambda d: S.sample_windows(d, low=d.idiv("n", "4")), EPISODES),
    **{f.__name__: Operator(f, EPISODES | {"cached": cached}) for f in (S.cache_missing, S.cache_complete)},
    "action_jobs": Operator(S.action_jobs, {"tasks": X.tasks}),
    **{f.__name__: Operator(f, ASK) for f in (A.response_join, A.hand_vlm_summary, A.token_usage)},
    **{f.__name__: Operator(f, {"responses": X.responses}) for f in (A.parse_json_greedy, A.parse_audit, A.all_failed)},
    **{f.__name__: Operator(f, FRAMES) for f in (A.hand_retry_merge, A.hand_best_box, A.hand_yolo_summary, A.run_summary)},
    **{f.__name__: Operator(f, FRAMES) for f in (G.hanning_weights, G.cut_clusters_chain, G.cut_min_length, G.merge_adjacent, G.merge_adjacent_ci)},
    **{f.__name__: Operator(f, FRAMES) for f in (B.positive_ranges, B.blur_summary, B.interval_union)},
    **{f.__name__: Operator(f, BOXES) for f in (B.box_dedupe, B.box_blur_region)},
    "caption_tree": Operator(C.caption_tree, TREE),
    "refine_validate": Query(C.validated, Operator(C.refine_validate, TREE).oracle(), TREE),
    **{f.__name__: Operator(f, {"tasks": X.tasks}) for f in (C.overall_instruction, C.cut_plan_task, C.cut_manifest)},
    "cut_plan_action": Operator(C.cut_plan_action, {"actions": X.actions}),
    "sop_join": Operator(C.sop_join, {"part": table("part")}),
    **{f.__name__: Operator(f, MEDIA) for f in (M.transcode_plan, M.effective_spec)},
    **{f.__name__: Operator(f, {"probes": X.probes}) for f in (M.encoder_choice, M.cut_commands)},
    "verify_output": Operator(M.verify_output, {"probes": X.probes, "outputs": X.outputs}),
    # these run without a join by range; the SQL that has one is the other engine's
    **{f.__name__: Query(build, Operator(f, FRAMES).oracle(), FRAMES) for f, build in ((G.cut_clusters_anchor, W.anchor_clusters), (G.segment_vote_overlap, W.vote_overlap), (G.segment_vote_timeline, W.vote_timeline), (G.task_segments, W.task_segments))},
    "subtitle_lookup": Query(W.subtitles, Operator(C.subtitle_lookup, TREE).oracle(), TREE),
    "hand_summaries": Operator(A.hand_summaries, FRAMES | ASK),
    "generic_segments": Query(L.generic_segments, Operator(N.generic_segments, {"windows": X.windows}).oracle(), {"windows": X.windows}),
    "refined_tasks": Operator(N.refined_tasks, {"parts": X.parts, "proposals": X.proposals}),
    "two_level_captions": Query(L.two_level_captions, Operator(N.two_level_captions, {"windows": X.windows, "inner": X.inner}).oracle(), {"windows": X.windows, "inner": X.inner}),
    **{f.__name__: Operator(f, {"paths": X.paths}) for f in (P.candidate_rank, P.path_resolve, P.drop_parent)},
    "text_helpers": Operator(P.text_helpers, {"documents": table("documents")}),
    "parse_rates": Operator(P.parse_rates, {"part": table("part")}),
    **{name: Query(build, sql, {t: table(t) for t in tables}) for name, (build, sql, tables) in (R.QUERIES | L.QUERIES | I.QUERIES | U.QUERIES | V.QUERIES).items()},
    "asof_nearest": Operator(P.asof_nearest, FRAMES),
    "imu_magnitude": Operator(P.imu_magnitude, {"embeddings": table("embeddings")}),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: op.run for name, op in OPERATORS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: op.oracle() for name, op in OPERATORS.items()}
