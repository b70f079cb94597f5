"""Records that flow between operators, as schemas, and a check that gives a DataFrame one's columns and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

EPISODE = "episode long, n long, fps double"
WINDOW = "episode long, window_id long, start_frame long, end_frame long, frame_ids array<long>"
SEGMENT = "episode long, s long, e long, instruction string"
PROBE = "path string, codec string, width int, height int, fps double, bitrate_kbps int, duration_sec double, pix_fmt string, container string, audio_codec string, rotation int"
FRAME_QUALITY = "episode long, frame_idx long, laplacian_var double, tenengrad double, mean_brightness double, is_blurry boolean"
FRAME_EXPOSURE = "episode long, frame_idx long, over_ratio double, under_ratio double, dynamic_range double, entropy double, over_exposed boolean, under_exposed boolean"
PAIR_MOTION = "episode long, frame_a long, frame_b long, frame_mid long, dx double, dy double, da double, jitter boolean"
STABILITY = "episode long, pairs long, translation_std double, rotation_std double, jitters long, pass boolean"
BOX = "episode long, frame_idx long, det_idx long, conf double, x1 double, y1 double, x2 double, y2 double"
ANSWER = "custom_id string, text string, prompt_tokens long, completion_tokens long, status_code int, error string"


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """df's columns of the schema, in its order and types; a missing column, or one of a type that doesn't cast, is an error."""
    want = StructType.fromDDL(ddl)
    if lost := [f.name for f in want if f.name not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(lost)}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in want))
