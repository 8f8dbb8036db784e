"""Text pieces of a training row and the native token estimate."""

from pyspark.sql import Column, functions as F

from trajspark.settings import check_level

# Literals of the row format.
IMAGE_MARK = "<image>"
BLOCK_GAP = "\n\n"
# Two characters, backslash and n, follow the word python in the coded layout.
CODE_OPEN_CODED = "\n## Code: ```python\\n"
TASK_OPEN = "# Task Instruction:\n"
CODE_OPEN_DOCUMENTED = "## Code:\n```python\n"

# One match per estimated token: runs of letters and marks, up to three digits, runs of
# anything else printable, runs of blanks. The classes are disjoint, so the count of a text
# is the sum over pieces cut where the class changes.
# Possessive, and in order of frequency: no backtracking.
TOKEN_PATTERN = r"[\p{L}\p{M}]++|\s++|[^\s\p{L}\p{N}\p{M}]++|\p{N}{1,3}+"

LAYOUTS = ("coded", "documented")


def check_layout(layout):
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}, expected one of {', '.join(LAYOUTS)}")
    return layout


def estimate_tokens(text: Column) -> Column:
    """Token estimate on built-in expressions; null and empty text count 0.

    The pattern covers every character, so one letter per match leaves a text as long as the
    number of matches, without an array of all tokens.
    """
    return F.coalesce(F.length(F.regexp_replace(text, TOKEN_PATTERN, "t")),
                      F.lit(0)).cast("long")


def _section(name, body, layout):
    if layout == "documented":
        return F.concat(F.lit(f"## {name}:\n"), body, F.lit("\n"))
    return F.concat(F.lit(f"## {name}: "), body)


def step_heading(index: Column) -> Column:
    """The label follows the stored index, not the position in the array."""
    return F.concat(F.lit("# Step "), (index + F.lit(1)).cast("string"))


def action_turn(index, action, layout="coded") -> Column:
    """Heading and action: a history block, and every recent turn but the last."""
    return F.concat(step_heading(index), F.lit("\n"), _section("Action", action, layout))


def target_turn(level, index, observation, thought, action, code, layout="coded") -> Column:
    """The last turn: L1 action and code, L2 adds the thought, L3 adds the observation."""
    check_level(level)
    lead = {"L1": [], "L2": [("Thought", thought)],
            "L3": [("Observation", observation), ("Thought", thought)]}[level]
    if layout == "documented":
        parts = [_section(n, c, layout) for n, c in lead]
        parts += [_section("Action", action, layout),
                  F.concat(F.lit(CODE_OPEN_DOCUMENTED), code, F.lit("\n```"))]
        return F.concat(step_heading(index), F.lit("\n"), *parts)
    parts = [F.concat(_section(n, c, layout), F.lit("\n")) for n, c in lead]
    parts += [_section("Action", action, layout),
              F.concat(F.lit(CODE_OPEN_CODED), code, F.lit("```"))]
    lines = [step_heading(index)] + parts
    glued = [lines[0]]
    for part in lines[1:]:
        glued += [F.lit("\n"), part]
    return F.concat(*glued)


def _blank_end(text: Column) -> Column:
    return F.coalesce(~F.right(text, F.lit(1)).rlike(r"\S"), F.lit(True))


def estimate_step(level, index, observation, thought, action, code):
    """(block, joined, target) estimates of one step, reading each of its texts once.

    The texts are cut where the character class changes: after the colon of a section name and
    after the backslash of the code opening. A line break after a section is one token more,
    unless the section ends blank already.
    """
    def section(text):
        return estimate_tokens(F.concat(F.lit(" "), text))

    def gap(text):
        return F.when(_blank_end(text), 0).otherwise(1)

    # Estimates of "## Name:", of the code opening up to its backslash, and of
    # a heading line without its number.
    name, opening, line = F.lit(4), F.lit(8), F.lit(5)
    number = F.length(F.abs(index + F.lit(1)).cast("string"))
    heading = line + F.ceil(number / F.lit(3)) + F.when(index < -1, 1).otherwise(0)
    said = name + section(action)
    block = (heading + said).cast("long")
    joined = (block + gap(action)).cast("long")
    if level is None:
        return block, joined, None
    target = joined + opening + estimate_tokens(F.concat(F.lit("n"), code, F.lit("```")))
    for text in {"L1": [], "L2": [thought], "L3": [observation, thought]}[check_level(level)]:
        target = target + name + section(text) + gap(text)
    return block, joined, target.cast("long")


estimate_tokens.step = estimate_step
estimate_tokens.never_null = True
estimate_tokens.native = True         # made of built-in expressions, so it can run inside an array


def asked(instruction, ask) -> Column:
    """The last user turn of the documented layout."""
    return F.concat(F.lit(TASK_OPEN), instruction, F.lit(f"{BLOCK_GAP}{ask}"))


def join_root(root, image: Column) -> Column:
    """Image name below an optional root folder."""
    return image if not root else F.concat(F.lit(root.rstrip("/") + "/"), image)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def model_from_file(path: Column) -> Column:
    """Label from a result file name; only the two known endings are taken off."""
    name = base_name(path)
    for ending in ("_tokens.json", "_tokens_accurate.json"):
        name = F.replace(name, F.lit(ending), F.lit(""))
    return name
