"""Row-by-row reading of the row format, for small fixtures only."""

from fractions import Fraction
from math import ceil, floor

import regex

TOKEN = regex.compile(r"[\p{L}\p{M}]+|\p{N}{1,3}|[^\s\p{L}\p{N}\p{M}]+|\s+")


def tokens(text):
    return len(TOKEN.findall(text or ""))


def turn(step):
    return f"# Step {step['index'] + 1}\n## Action: {step['value']['action']}"


def target(step, level):
    v = step["value"]
    out = f"# Step {step['index'] + 1}\n"
    if level == "L3":
        out += f"## Observation: {v['observation']}\n\n"
    if level in ("L2", "L3"):
        out += f"## Thought: {v['thought']}\n\n"
    return out + f"## Action: {v['action']}\n\n## Code: ```python\\n{v['code']}```"


def shown_positions(n, k, aligned=False):
    if n <= k:
        return list(range(n))
    first = n - k if aligned else n - k - 1
    return [first] + list(range(n - k + 1, n))


def row(task, n, level, prompt, k=3, aligned=False):
    steps = task["traj"][:n]
    messages = [("system", prompt)]
    if n > k:
        messages += [("user", task["instruction"]),
                     ("assistant", "\n\n".join(turn(s) for s in steps[:n - k])),
                     ("user", "<image>")]
    else:
        messages.append(("user", task["instruction"] + "<image>"))
    for s in steps[max(0, n - k):-1]:
        messages += [("assistant", turn(s)), ("user", "<image>")]
    messages.append(("assistant", target(steps[-1], level)))
    return messages, [steps[p]["image"] for p in shown_positions(n, k, aligned)]


def text_tokens(messages, count=tokens):
    return sum(count(c) for _, c in messages if c and c != "<image>")


def tiles(w, h):
    """Exact ratios instead of doubles; sides below 2**20 cannot tell them apart."""
    long, short = Fraction(max(w, h)), Fraction(min(w, h))
    for side, limit in (("long", 2048), ("short", 768)):
        reach = long if side == "long" else short
        if reach > limit:
            long, short = ((limit, floor(short * limit / long)) if side == "long"
                           else (floor(long * limit / short), limit))
            long, short = Fraction(long), Fraction(short)
    return 85 + 170 * ceil(long / 512) * ceil(short / 512)


def step(i, image=None, text="do it", thought="hm", index=None):
    return {"index": i if index is None else index, "image": image or f"s{i}.png",
            "value": {"observation": f"screen {i}", "thought": thought, "action": text,
                      "code": f"click({i})", "last_step_correct": True,
                      "last_step_redundant": False, "reflection": None}}


def task(task_id, n, score=7, instruction="sort it", **kw):
    return {"task_id": task_id, "instruction": instruction, "task_completed": True,
            "alignment_score": score, "efficiency_score": 5, "task_difficulty": 2,
            "natural_language_task": "x", "actual_task": "y",
            "traj": [step(i, f"{task_id}_{i}.png", **kw) for i in range(n)]}
