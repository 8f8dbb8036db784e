"""Job defaults and the rate table. All of them can be overridden by arguments."""

from typing import NamedTuple


class Model(NamedTuple):
    encoding: str
    supports_vision: bool
    input_price_per_1m: float
    output_price_per_1m: float
    image_token_multiplier: float = 1.0


# The published rate table. Add a tier with {**MODELS, "mine": Model(...)}.
MODELS = {
    "gpt-4o": Model("o200k_base", True, 2.50, 10.00, 1.0),
    "gpt-4o-mini": Model("o200k_base", True, 0.15, 0.60, 33.33),
    "gpt-4o-2024-11-20": Model("o200k_base", True, 2.50, 10.00, 1.0),
    "gpt-4o-2024-08-06": Model("o200k_base", True, 2.50, 10.00, 1.0),
    "o4-mini": Model("o200k_base", True, 1.10, 0.275, 1.72),
    "gpt-5": Model("o200k_harmony", True, 1.25, 10.00, 1.0),
    "gpt-5-mini": Model("o200k_harmony", True, 0.25, 2.00, 1.62),
}
DEFAULT_MODEL = "gpt-5"

# Job constants.
OUTPUT_TOKENS = 8092     # priced output tokens per conversation
WINDOW = 3               # screenshots (and recent turns) shown per training row
MIN_SCORE = 5            # lowest alignment score kept
MIN_PREFIX_INDEX = 0     # first prefix position emitted
DEFAULT_LEVEL = "L2"
LEVELS = ("L1", "L2", "L3")

# Own short system prompts; pass your own {level: text} to replace them.
PROMPTS = {
    "L1": "You operate a desktop. Answer with the next action and its code.",
    "L2": "You operate a desktop. Answer with a thought, the next action and its code.",
    "L3": "You operate a desktop. Answer with an observation, a thought, the next action "
          "and its code.",
}


# Fixed value: the question of the documented layout.
ASK = "Please generate the next move."


def check_level(level):
    if level not in LEVELS:
        raise ValueError(f"unknown level {level!r}, expected one of {', '.join(LEVELS)}")
    return level


def select_models(names=None, models=None):
    """The requested part of a rate table; unknown names are rejected with the known ones."""
    models = MODELS if models is None else models
    if names is None:
        return dict(models)
    unknown = [name for name in names if name not in models]
    if unknown:
        raise ValueError(f"unsupported model(s) {unknown}; supported: {sorted(models)}")
    return {name: models[name] for name in names}
