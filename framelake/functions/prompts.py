"""Prompts as templates with `$name` places, rendered as a Column or as SQL text. Field names and labels are fixed values."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from framelake.functions.text import SCENES


class Template:
    def __init__(self, text: str):
        self.parts = re.split(r"\$(\w+)", text)

    @property
    def names(self) -> list[str]:
        return self.parts[1::2]

    def column(self, **values: Column) -> Column:
        return F.concat(*(F.lit(x) if i % 2 == 0 else values[x].cast("string") for i, x in enumerate(self.parts) if i % 2 or x))

    def sql(self, **values: str) -> str:
        quoted = lambda x: "'" + x.replace("'", "''") + "'"
        return "concat(" + ", ".join(quoted(x) if i % 2 == 0 else f"CAST({values[x]} AS VARCHAR)" for i, x in enumerate(self.parts) if i % 2 or x) + ")"


_SPAN = "These $n frames, numbered from 0, are an even sample of a first-person video from second $start to second $end."
_RULES = "Report a change only where the frames show it clearly, as the number of the first frame after it; without one, report none. Answer with JSON only, with the fields"

STEPS = Template(f'{_SPAN} It shows manual work$task. Find where one step ends and the next begins. {_RULES} "thought", "transitions" (frame numbers) and "instructions": what is done before the first change, after it, and so on, one more than there are changes.')
TASKS = Template(f'{_SPAN} Find where the person turns from one goal to another; several actions for one goal are one task. {_RULES} "thought", "transitions" (frame numbers) and "tasks": an object with "instruction", one short sentence, for each task, one more than there are changes.')
ACTIONS = Template(f'{_SPAN} They belong to the task: $task. Find where one atomic action ends and the next begins. {_RULES} "thought", "transitions" (frame numbers) and "actions": names in lower case with underscores, one more than there are changes.')
SOP_STEPS = Template(f'{_SPAN} The work follows a procedure, $task:\n$steps\nFind where one of its steps is done and the next begins. {_RULES} "thought", "transitions" (frame numbers) and "instructions": what is done before the first change, after it, and so on, one more than there are changes.')
SCENE = Template(f'These $n frames are an even sample of a whole first-person video of $seconds seconds. Choose the scene label that fits most of it, one of {", ".join(SCENES)}; when in doubt, unknown. Answer with JSON only, with the fields "thought" and "scene".')
_BOUNDS = 'Use only bounds that are there already, leave no gap, and cover the same frames. Answer with a JSON list only, of objects with "frame_interval", "instruction"'
MERGE_TASKS = Template(f"Neighbouring segments of a video may be one task. Merge each run of them that has one goal into a single segment, from the first one's start to the last one's end, and say its goal in one sentence. {_BOUNDS}. Segments:\n$segments")
MERGE_STEPS = Template(f'Segments of a video that follows a procedure, $task:\n$steps\nGive each the number of its step, merge neighbours of one step, and word each as that step alone. Numbers must not fall. {_BOUNDS} and "sop_step_index". Segments:\n$segments')


def images(n: Column, start: Column, end: Column, fps: Column) -> dict[str, Column]:
    """The places of a window's template."""
    from framelake.functions.columns import tenths

    return {"n": n, "start": tenths(start / fps), "end": tenths(end / fps)}
