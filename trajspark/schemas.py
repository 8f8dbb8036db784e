"""Declared schemas as DDL strings; nothing in the library infers one."""

STEP_VALUE = (
    "struct<observation:string, thought:string, action:string, code:string, "
    "last_step_correct:boolean, last_step_redundant:boolean, reflection:string>"
)
STEP = f"struct<index:bigint, image:string, value:{STEP_VALUE}>"

TRAJECTORY = (
    "task_id string, instruction string, task_completed boolean, "
    "alignment_score bigint, efficiency_score bigint, task_difficulty bigint, "
    "natural_language_task string, actual_task string, "
    f"traj array<{STEP}>"
)

MESSAGE = "struct<role:string, content:string>"

# Keys are ours: the documented row has only `messages` and `images`.
TRAINING_ROW = (
    "task_id string, prefix_len bigint, level string, "
    f"messages array<{MESSAGE}>, images array<string>"
)

# status: ok | corrupt; a missing file has no row.
IMAGE_DIMS = "path string, width bigint, height bigint, status string"
# What a table that is refreshed keeps besides.
STORED_DIMS = IMAGE_DIMS + ", size bigint, modified bigint"

MODEL_CONFIG = (
    "struct<encoding:string, supports_vision:boolean, input_price_per_1m:double, "
    "output_price_per_1m:double, image_token_multiplier:double>"
)

# Field names of the result-set document.
TOKEN_TOTALS = (
    "total_text_tokens", "total_image_tokens", "total_input_tokens",
    "total_output_tokens", "total_tokens", "total_images",
)
COST_TOTALS = ("total_input_cost", "total_output_cost", "total_cost")
AVERAGES = (
    "avg_text_tokens", "avg_image_tokens", "avg_total_input_tokens", "avg_output_tokens",
    "avg_total_tokens", "avg_images_per_conversation", "avg_cost_per_conversation",
)
CONFIG_FIELDS = (
    "encoding", "supports_vision", "input_price_per_1m", "output_price_per_1m",
    "image_token_multiplier",
)

# `per_conversation` is left out on purpose: the comparison never needs it.
RESULT_SET = (
    f"model string, model_config {MODEL_CONFIG}, input_file string, "
    "total_conversations bigint, totals struct<"
    + ", ".join([f"{c}:bigint" for c in TOKEN_TOTALS] + [f"{c}:double" for c in COST_TOTALS])
    + ">, averages struct<" + ", ".join(f"{c}:double" for c in AVERAGES) + ">"
)
