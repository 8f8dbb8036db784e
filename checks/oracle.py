"""The same results in plain SQL.

Written against the row format, not against the library's plan: every message of every prefix
is built as text and then counted.
"""

from checks import views as V
from trajspark.settings import MODELS, OUTPUT_TOKENS, PROMPTS

NL = "chr(10)"
PATTERN = r"[\p{L}\p{M}]+|\p{N}{1,3}|[^\s\p{L}\p{N}\p{M}]+|\s+"


def quoted(s):
    return "'" + s.replace("'", "''") + "'"


def tok(x):
    return (f"(CASE WHEN coalesce({x}, '') IN ('', '<image>') THEN 0 "
            f"ELSE len(regexp_extract_all({x}, {quoted(PATTERN)})) END)::BIGINT")


def _d(x):
    return f"CAST({x!r} AS DOUBLE)"


STEPS = """steps AS (
  SELECT conv_id AS task_id, turn - 1 AS pos, text AS action,
         'screen ' || (turn - 1) AS observation, 'thought of ' || (turn - 1) AS thought,
         'click(' || (turn - 1) || ')' AS code,
         conv_id || '_' || (turn - 1) || '.png' AS image
  FROM conversations WHERE turn > 0)"""
TASKS = """tasks AS (
  SELECT conv_id AS task_id, text AS instruction,
         least(10, length(text) // 25)::BIGINT AS alignment_score,
         CASE conv_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS dataset
  FROM conversations WHERE turn = 0)"""
DIMS = f"""dims AS (
  SELECT conv_id || '_' || (turn - 1) || '.png' AS path,
         1 + (conv_id * 977 + (turn - 1) * 613) % 4200 AS width,
         1 + (conv_id * 541 + (turn - 1) * 389) % 3000 AS height,
         CASE WHEN length(text) < {V.CORRUPT_BELOW} THEN 'corrupt' ELSE 'ok' END AS status
  FROM conversations WHERE turn > 0 AND length(text) >= {V.MISSING_BELOW})"""
FITTED = """fitted AS (
  SELECT path, width, height, status,
    CASE WHEN width <= 2048 AND height <= 2048 THEN width
         WHEN width > height THEN 2048
         ELSE CAST(trunc(width * 2048 / height) AS BIGINT) END AS w1,
    CASE WHEN width <= 2048 AND height <= 2048 THEN height
         WHEN width > height THEN CAST(trunc(height * 2048 / width) AS BIGINT)
         ELSE 2048 END AS h1
  FROM dims)"""
SHRUNK = """shrunk AS (
  SELECT *,
    CASE WHEN w1 < h1 THEN least(w1, 768)
         WHEN h1 > 768 THEN CAST(trunc(w1 * 768 / h1) AS BIGINT) ELSE w1 END AS w2,
    CASE WHEN w1 >= h1 THEN least(h1, 768)
         WHEN w1 > 768 THEN CAST(trunc(h1 * 768 / w1) AS BIGINT) ELSE h1 END AS h2
  FROM fitted)"""
TILES = """tiles AS (
  SELECT path, width, height, status,
         CASE WHEN status = 'ok' THEN
           (85 + 170 * ceil(w2 / 512.0) * ceil(h2 / 512.0))::BIGINT END AS tile_tokens
  FROM shrunk)"""
MODEL_ROWS = "models AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {quoted(name)}, {quoted(m.encoding)}, {'true' if m.supports_vision else 'false'}, "
    f"{_d(m.input_price_per_1m)}, {_d(m.output_price_per_1m)}, {_d(m.image_token_multiplier)})"
    for i, (name, m) in enumerate(MODELS.items())
) + ") v(ord, model, encoding, supports_vision, in_rate, out_rate, mult))"
PREFIXES = """prefixes AS (
  SELECT s.task_id, s.pos + 1 AS n FROM steps s JOIN tasks t ON t.task_id = s.task_id)"""
SHOWN = """shown AS (
  SELECT p.task_id, p.n AS prefix_len,
         row_number() OVER (PARTITION BY p.task_id, p.n ORDER BY s.pos) AS img_pos, s.image
  FROM prefixes p JOIN steps s ON s.task_id = p.task_id
  WHERE s.pos = greatest(p.n - 4, 0)
     OR (s.pos > greatest(p.n - 3, 0) AND s.pos < p.n))"""
BLOCK = f"'# Step ' || (s.pos + 1) || {NL} || '## Action: ' || s.action"
HISTORY = f"""history AS (
  SELECT p.task_id, p.n, string_agg({BLOCK}, {NL} || {NL} ORDER BY s.pos) AS history
  FROM prefixes p JOIN steps s ON s.task_id = p.task_id AND s.pos < p.n - 3
  GROUP BY 1, 2)"""


def _target(level):
    parts = [f"'# Step ' || (s.pos + 1)"]
    if level == "L3":
        parts.append(f"'## Observation: ' || s.observation || {NL}")
    if level in ("L2", "L3"):
        parts.append(f"'## Thought: ' || s.thought || {NL}")
    parts.append("'## Action: ' || s.action")
    parts.append(f"{NL} || '## Code: ```python\\n' || s.code || '```'")
    return f" || {NL} || ".join(parts)


def _messages(level):
    start = "3 + CASE WHEN p.n > 3 THEN 2 ELSE 0 END + 2 * (s.pos - greatest(p.n - 3, 0))"
    recent = ("prefixes p JOIN steps s ON s.task_id = p.task_id "
              "AND s.pos >= p.n - 3 AND s.pos < p.n")
    return f"""messages AS (
  SELECT task_id, n AS prefix_len, 1::BIGINT AS msg_pos, 'system' AS role,
         {quoted(PROMPTS[level])} AS content FROM prefixes
  UNION ALL
  SELECT p.task_id, p.n, 2, 'user',
         t.instruction || CASE WHEN p.n <= 3 THEN '<image>' ELSE '' END
  FROM prefixes p JOIN tasks t ON t.task_id = p.task_id
  UNION ALL SELECT task_id, n, 3, 'assistant', history FROM history
  UNION ALL SELECT task_id, n, 4, 'user', '<image>' FROM history
  UNION ALL
  SELECT p.task_id, p.n, {start}, 'assistant',
         CASE WHEN s.pos = p.n - 1 THEN {_target(level)} ELSE {BLOCK} END
  FROM {recent}
  UNION ALL
  SELECT p.task_id, p.n, {start} + 1, 'user', '<image>'
  FROM {recent} AND s.pos < p.n - 1)"""


def _documented():
    block = f"'# Step ' || (s.pos + 1) || {NL} || '## Action:' || {NL} || s.action || {NL}"
    target = (f"'# Step ' || (s.pos + 1) || {NL} || '## Thought:' || {NL} || s.thought || {NL} "
              f"|| '## Action:' || {NL} || s.action || {NL} || '## Code:' || {NL} "
              f"|| '```python' || {NL} || s.code || {NL} || '```'")
    start = "2 + CASE WHEN p.n > 3 THEN 1 ELSE 0 END + 2 * (s.pos - greatest(p.n - 3, 0))"
    recent = ("prefixes p JOIN steps s ON s.task_id = p.task_id "
              "AND s.pos >= p.n - 3 AND s.pos < p.n")
    return f"""WITH {STEPS}, {TASKS}, {PREFIXES}, history AS (
  SELECT p.task_id, p.n, string_agg({block}, {NL} || {NL} ORDER BY s.pos) AS history
  FROM prefixes p JOIN steps s ON s.task_id = p.task_id AND s.pos < p.n - 3 GROUP BY 1, 2)
SELECT task_id, n AS prefix_len, 1::BIGINT AS msg_pos, 'system' AS role,
       {quoted(PROMPTS["L2"])} AS content FROM prefixes
UNION ALL SELECT task_id, n, 2, 'assistant', history FROM history
UNION ALL SELECT p.task_id, p.n, {start}, 'user', '<image>' FROM {recent}
UNION ALL SELECT p.task_id, p.n, {start} + 1, 'assistant', {block} FROM {recent}
  AND s.pos < p.n - 1
UNION ALL SELECT p.task_id, p.n, {start} + 1, 'user', '# Task Instruction:' || {NL}
  || t.instruction || {NL} || {NL} || 'Please generate the next move.'
  FROM {recent} AND s.pos = p.n - 1 JOIN tasks t ON t.task_id = p.task_id
UNION ALL SELECT p.task_id, p.n, {start} + 2, 'assistant', {target} FROM {recent}
  AND s.pos = p.n - 1"""


def _billed(tile, status):
    return (f"(CASE WHEN NOT m.supports_vision THEN 0 "
            f"WHEN {status} = 'ok' THEN CAST(trunc({tile} * m.mult) AS BIGINT) "
            f"WHEN {status} = 'corrupt' THEN CAST(trunc(255 * m.mult) AS BIGINT) "
            f"ELSE 0 END)::BIGINT")


BILLED = _billed("x.tile_tokens", "x.status")
BASE = (f"CASE WHEN m.mult > 1 THEN CAST(trunc({BILLED} / m.mult) AS BIGINT) "
        f"ELSE {BILLED} END")
VIEWS = ", ".join([STEPS, TASKS, DIMS, FITTED, SHRUNK, TILES, MODEL_ROWS, PREFIXES, SHOWN])


def _usage(keys, texts, images):
    """usage CTE from `texts` (keys, text_tokens) and `images` (keys, image)."""
    on = " AND ".join(f"i.{k} = t.{k}" for k in keys)
    ks = ", ".join(keys)
    tks = ", ".join(f"t.{k}" for k in keys)
    return f"""texts AS ({texts}), pics AS ({images}),
pic_sums AS (
  SELECT {ks}, m.model, count(*) AS image_count, sum({BILLED})::BIGINT AS image_tokens
  FROM pics LEFT JOIN tiles x ON x.path = pics.image CROSS JOIN models m
  GROUP BY {ks}, m.model),
counted AS (
  SELECT {tks}, m.model, m.in_rate, m.out_rate, t.text_tokens,
         coalesce(i.image_tokens, 0)::BIGINT AS image_tokens,
         coalesce(i.image_count, 0)::BIGINT AS image_count
  FROM texts t CROSS JOIN models m LEFT JOIN pic_sums i ON {on} AND i.model = m.model),
usage AS (
  SELECT {ks}, model, text_tokens, image_tokens, image_count,
         text_tokens + image_tokens AS total_input_tokens,
         {OUTPUT_TOKENS}::BIGINT AS output_tokens,
         text_tokens + image_tokens + {OUTPUT_TOKENS} AS total_tokens,
         (text_tokens + image_tokens) / 1e6::DOUBLE * in_rate AS input_cost,
         {OUTPUT_TOKENS} / 1e6::DOUBLE * out_rate AS output_cost,
         (text_tokens + image_tokens) / 1e6::DOUBLE * in_rate
           + {OUTPUT_TOKENS} / 1e6::DOUBLE * out_rate AS total_cost
  FROM counted)"""


ROW_TEXTS = (f"SELECT task_id, prefix_len, sum({tok('content')})::BIGINT AS text_tokens "
             "FROM messages GROUP BY 1, 2")
ROW_USAGE = (f"WITH {VIEWS}, {HISTORY}, {_messages('L2')}, "
             + _usage(("task_id", "prefix_len"), ROW_TEXTS,
                      "SELECT task_id, prefix_len, image FROM shown"))
ALL_USAGE = ROW_USAGE + " SELECT * FROM usage"


def _totals(by="", where="", usage=ROW_USAGE):
    """Closing CTE `totals`, one row per model (and per `by`)."""
    g = f"{by}, " if by else ""
    return usage + f""", sums AS (
  SELECT {g}u.model, count(*) AS n, sum(text_tokens)::BIGINT AS tt,
         sum(image_tokens)::BIGINT AS it, sum(image_count)::BIGINT AS ic
  FROM usage u JOIN tasks t ON t.task_id = u.task_id {where} GROUP BY {g}u.model),
totals AS (
  SELECT {g}m.ord, m.model, m.encoding, m.supports_vision,
    m.in_rate AS input_price_per_1m, m.out_rate AS output_price_per_1m,
    m.mult AS image_token_multiplier, n AS total_conversations, tt AS total_text_tokens,
    it AS total_image_tokens, tt + it AS total_input_tokens,
    (n * {OUTPUT_TOKENS})::BIGINT AS total_output_tokens,
    (tt + it + n * {OUTPUT_TOKENS})::BIGINT AS total_tokens, ic AS total_images,
    (tt + it) / 1e6::DOUBLE * m.in_rate AS total_input_cost,
    (n * {OUTPUT_TOKENS}) / 1e6::DOUBLE * m.out_rate AS total_output_cost,
    (tt + it) / 1e6::DOUBLE * m.in_rate
      + (n * {OUTPUT_TOKENS}) / 1e6::DOUBLE * m.out_rate AS total_cost,
    tt::DOUBLE / n AS avg_text_tokens, it::DOUBLE / n AS avg_image_tokens,
    (tt + it)::DOUBLE / n AS avg_total_input_tokens,
    (n * {OUTPUT_TOKENS})::DOUBLE / n AS avg_output_tokens,
    (tt + it + n * {OUTPUT_TOKENS})::DOUBLE / n AS avg_total_tokens,
    ic::DOUBLE / n AS avg_images_per_conversation,
    ((tt + it) / 1e6::DOUBLE * m.in_rate
      + (n * {OUTPUT_TOKENS}) / 1e6::DOUBLE * m.out_rate) / n AS avg_cost_per_conversation
  FROM sums JOIN models m ON m.model = sums.model)"""


TOTALS = _totals()
DATASET_TOTALS = _totals("dataset")


def _matrix(metrics, kind):
    parts = []
    for i, (label, column) in enumerate(metrics):
        cells = ", ".join(
            f"max(CASE WHEN model = {quoted(m)} THEN {column} END)::{kind} AS \"{m}\""
            for m in sorted(MODELS))
        parts.append(f"SELECT {i}::BIGINT AS metric_ord, {quoted(label)} AS metric, {cells} "
                     "FROM totals")
    return TOTALS + " " + " UNION ALL ".join(parts)


TOKEN_METRICS = [
    ("Conversations", "total_conversations"), ("Total Text Tokens", "total_text_tokens"),
    ("Total Image Tokens", "total_image_tokens"), ("Total Input Tokens", "total_input_tokens"),
    ("Total Output Tokens", "total_output_tokens"), ("Total Tokens", "total_tokens"),
    ("Total Images", "total_images")]
AVERAGE_METRICS = [
    ("Avg Text Tokens", "avg_text_tokens"), ("Avg Image Tokens", "avg_image_tokens"),
    ("Avg Input Tokens", "avg_total_input_tokens"), ("Avg Output Tokens", "avg_output_tokens"),
    ("Avg Total Tokens", "avg_total_tokens"), ("Avg Images", "avg_images_per_conversation")]


def _report():
    whole = [("Conversations processed", "total_conversations"),
             ("Text tokens", "total_text_tokens"), ("Image tokens", "total_image_tokens"),
             ("Total input tokens", "total_input_tokens"),
             ("Total output tokens", "total_output_tokens"), ("Total tokens", "total_tokens"),
             ("Total images", "total_images")]
    lines = [(k, f"format('{{:,}}', {c})") for k, c in whole]
    lines += [(k, f"printf('%.1f', {c})") for k, c in AVERAGE_METRICS]
    lines += [(k, f"'$' || printf('%.2f', {c})") for k, c in (
        ("Input cost", "total_input_cost"), ("Output cost", "total_output_cost"),
        ("Total cost", "total_cost"))]
    lines += [("Avg cost per conversation", "'$' || printf('%.4f', avg_cost_per_conversation)"),
              ("Input rate", "'$' || printf('%.2f', input_price_per_1m) || '/1M'"),
              ("Output rate", "'$' || printf('%.2f', output_price_per_1m) || '/1M'"),
              ("Vision support", "CASE WHEN supports_vision THEN 'Yes' ELSE 'No' END"),
              ("Image token multiplier", "image_token_multiplier || 'x'")]
    return TOTALS + " " + " UNION ALL ".join(
        f"SELECT model, {i}::BIGINT AS line, {quoted(k)} AS label, {e} AS value FROM totals"
        for i, (k, e) in enumerate(lines))


def _could_fail(content):
    """What the failing counter makes of one message, per encoding."""
    return f"""CASE WHEN m.encoding = 'o200k_base' AND coalesce({content}, '') LIKE
    '%{V.UNCOUNTABLE}%' THEN NULL ELSE {tok(content)} END"""


FAILING_USAGE = f"""WITH {VIEWS}, {HISTORY}, {_messages('L2')}, texts AS (
  SELECT task_id, prefix_len, m.model, CASE WHEN count(*) = count({_could_fail('content')})
    THEN sum({_could_fail('content')}) END::BIGINT AS text_tokens
  FROM messages CROSS JOIN models m GROUP BY ALL),
pic_sums AS (
  SELECT task_id, prefix_len, m.model, count(*) AS image_count,
    sum({BILLED})::BIGINT AS image_tokens
  FROM shown LEFT JOIN tiles x ON x.path = shown.image CROSS JOIN models m GROUP BY ALL),
usage AS (
  SELECT * FROM texts JOIN pic_sums USING (task_id, prefix_len, model)
  WHERE text_tokens IS NOT NULL)"""
DOCUMENTED_USAGE = f"""WITH {VIEWS}, messages AS ({_documented()}), """ + _usage(
    ("task_id", "prefix_len"), ROW_TEXTS,
    """SELECT p.task_id, p.n AS prefix_len, s.image FROM prefixes p JOIN steps s
    ON s.task_id = p.task_id AND s.pos >= p.n - 3 AND s.pos < p.n""")
LENGTHS = "(SELECT task_id, max(pos) + 1 AS n FROM steps GROUP BY 1)"
SUMMED = """ SELECT model, total_conversations, total_text_tokens, total_image_tokens,
    total_images, total_cost FROM totals"""
KEPT = "AND t.alignment_score >= 5"
# The configuration of `checks.queries.BLIND`.
BLIND_ROWS = ("models AS (SELECT * FROM (VALUES (0, 'blind', 'o200k_base', false, 1.0::DOUBLE, "
              "2.0::DOUBLE, 1.0::DOUBLE), (1, 'gpt-5', 'o200k_harmony', true, 1.25::DOUBLE, "
              "10.0::DOUBLE, 1.0::DOUBLE)) "
              "v(ord, model, encoding, supports_vision, in_rate, out_rate, mult))")
FIRST = "(SELECT task_id, pos + 1 AS prefix_len FROM steps ORDER BY 1, 2 LIMIT {n})"
DETAILS = (f"WITH {VIEWS} SELECT s.task_id, s.prefix_len, m.model, s.img_pos, "
           f"s.image AS path, {BILLED} AS tokens, {BASE} AS base_tokens, m.mult AS multiplier "
           "FROM shown s LEFT JOIN tiles x ON x.path = s.image CROSS JOIN models m")
SHOWN_PATHS = (f"WITH {STEPS}, {TASKS}, {PREFIXES}, {SHOWN} SELECT task_id, prefix_len, "
               "img_pos, 'shots/' || image AS path FROM shown")
NO_ENCODING = " SELECT * EXCLUDE (ord, encoding, supports_vision) FROM totals"

ORACLE = {
    "training_set_cost": _totals("", "AND t.alignment_score >= 5")
    + """ SELECT model, total_conversations, total_text_tokens, total_image_tokens,
    total_tokens, total_cost, avg_cost_per_conversation FROM totals""",
    "alignment_filter": f"WITH {TASKS} SELECT task_id, alignment_score FROM tasks "
                        "WHERE alignment_score >= 5",
    "prefix_expand": f"WITH {STEPS} SELECT task_id, image, pos + 1 AS prefix_len FROM steps",
    "prefix_expand_nested": f"""WITH {STEPS} SELECT a.task_id, a.pos + 1 AS prefix_len,
    b.n AS n_steps, a.image FROM steps a
    JOIN (SELECT task_id, count(*) AS n FROM steps GROUP BY 1) b ON a.task_id = b.task_id""",
    "prefix_full_only": f"WITH {STEPS} SELECT task_id, max(pos) + 1 AS prefix_len "
                        "FROM steps GROUP BY 1",
    "prefix_min_length": f"WITH {STEPS} SELECT task_id, pos + 1 AS prefix_len FROM steps "
                         "WHERE pos >= 5",
    "history_block": f"""WITH {STEPS}, {TASKS}, {PREFIXES}, {HISTORY}
    SELECT p.task_id, p.n AS prefix_len, coalesce(h.history, '') AS history
    FROM prefixes p LEFT JOIN history h ON h.task_id = p.task_id AND h.n = p.n""",
    "image_window": SHOWN_PATHS,
    "training_images": SHOWN_PATHS,
    "image_window_aligned": f"""WITH {STEPS}, {TASKS}, {PREFIXES}
    SELECT p.task_id, p.n AS prefix_len,
      row_number() OVER (PARTITION BY p.task_id, p.n ORDER BY s.pos) AS img_pos,
      'shots/' || s.image AS path FROM prefixes p JOIN steps s ON s.task_id = p.task_id
      AND s.pos >= p.n - 3 AND s.pos < p.n""",
    **{f"training_messages_{v.lower()}":
       f"WITH {STEPS}, {TASKS}, {PREFIXES}, {HISTORY}, {_messages(v)} SELECT * FROM messages"
       for v in ("L1", "L2", "L3")},
    "training_messages_documented": _documented(),
    "quarantined_trajectories": f"""WITH {STEPS} SELECT DISTINCT task_id,
    'null thought' AS reason FROM steps WHERE length(action) < {V.MISSING_BELOW}""",
    "missing_images_strict": f"WITH {STEPS}, {DIMS} SELECT DISTINCT image AS path FROM steps "
                             "WHERE image NOT IN (SELECT path FROM dims)",
    "message_text_tokens": f"SELECT conv_id, turn, {tok('text')} AS tokens FROM conversations",
    "conversation_text_tokens": f"SELECT conv_id, sum({tok('text')})::BIGINT AS text_tokens "
                                "FROM conversations GROUP BY 1",
    "distinct_text_tokens": f"SELECT doc_id, {tok('text')} AS tokens FROM documents",
    "document_text_tokens": f"SELECT doc_id, {tok('text')} AS tokens FROM documents",
    "image_tile_tokens": f"WITH {DIMS}, {FITTED}, {SHRUNK}, {TILES} SELECT path, width, height, "
                         "tile_tokens FROM tiles WHERE status = 'ok'",
    "image_model_tokens": f"""WITH {VIEWS} SELECT s.image AS path,
    coalesce(x.status, 'missing') AS status, m.model, m.mult AS multiplier, {BILLED} AS tokens,
    {BASE} AS base_tokens
    FROM steps s LEFT JOIN tiles x ON x.path = s.image CROSS JOIN models m""",
    "legacy_image_delta": f"""WITH {DIMS}, {FITTED}, {SHRUNK}, {TILES}
    SELECT path, tile_tokens, 935::BIGINT AS legacy_tokens, tile_tokens - 935 AS delta
    FROM tiles WHERE status = 'ok'""",
    "conversation_usage": ALL_USAGE,
    "trajectory_usage": ALL_USAGE,
    "chunked_trajectory_usage": ALL_USAGE,
    "training_row_usage": ALL_USAGE,
    "placed_row_usage": ALL_USAGE,
    "chat_usage": f"WITH {VIEWS}, " + _usage(
        ("conv_id",), f"SELECT conv_id, sum({tok('text')})::BIGINT AS text_tokens "
        "FROM conversations GROUP BY 1", "SELECT task_id AS conv_id, image FROM steps")
    + " SELECT * FROM usage",
    "image_details": DETAILS,
    "usage_totals_by_model": TOTALS + NO_ENCODING,
    "usage_totals_from_rows": TOTALS + NO_ENCODING,
    "usage_totals_nested": TOTALS + NO_ENCODING,
    "usage_averages_by_model": TOTALS + """ SELECT model, avg_text_tokens, avg_image_tokens,
    avg_total_input_tokens, avg_output_tokens, avg_total_tokens, avg_images_per_conversation,
    avg_cost_per_conversation FROM totals""",
    "usage_by_dataset": DATASET_TOTALS + """ SELECT dataset, model, total_conversations,
    total_input_tokens, total_images, total_cost FROM totals""",
    "first_n_usage": ROW_USAGE + f""" SELECT u.* FROM usage u JOIN {FIRST.format(n=25)} f
    ON f.task_id = u.task_id AND f.prefix_len = u.prefix_len WHERE u.model = 'gpt-5'""",
    "usage_sample": ROW_USAGE + f""" SELECT s.task_id, s.prefix_len, u.text_tokens, s.img_pos,
    s.image AS name, {BILLED} AS tokens, {BASE} AS base_tokens, m.mult AS multiplier
    FROM shown s JOIN {FIRST.format(n=3)} f
      ON f.task_id = s.task_id AND f.prefix_len = s.prefix_len
    JOIN usage u ON u.task_id = s.task_id AND u.prefix_len = s.prefix_len
    JOIN models m ON m.model = u.model LEFT JOIN tiles x ON x.path = s.image
    WHERE m.model = 'gpt-4o-mini' AND s.img_pos <= 2""",
    "conversation_ids": f"""WITH {STEPS} SELECT task_id, pos + 1 AS prefix_len,
    row_number() OVER (ORDER BY task_id, pos) - 1 AS conversation_id FROM steps""",
    "nth_document": """WITH placed AS (SELECT lang, source, n_chars,
      row_number() OVER (ORDER BY lang, source, n_chars) AS k, count(*) OVER () AS n FROM documents),
    middle AS (SELECT * FROM placed WHERE k = (n + 1) // 2)
    SELECT p.lang, p.source, p.n_chars FROM placed p JOIN middle m
    ON p.lang = m.lang AND p.source = m.source AND p.n_chars = m.n_chars""",
    "document_ids": """SELECT lang, n_chars, doc_id,
    row_number() OVER (ORDER BY lang, n_chars, doc_id) - 1 AS number FROM documents""",
    "unknown_models": """SELECT 'custom-' || source AS model, count(*) AS requests
    FROM documents WHERE lang NOT IN ('en', 'de') GROUP BY 1""",
    "compare_token_matrix": _matrix(TOKEN_METRICS, "BIGINT"),
    "compare_average_matrix": _matrix(AVERAGE_METRICS, "DOUBLE"),
    "compare_pricing": TOTALS + """ SELECT model, input_price_per_1m AS input_rate,
    output_price_per_1m AS output_rate, total_input_cost AS input_cost,
    total_output_cost AS output_cost, total_cost,
    avg_cost_per_conversation AS cost_per_conv FROM totals""",
    "compare_features": TOTALS + """ SELECT model, encoding,
    CASE WHEN supports_vision THEN 'Yes' ELSE 'No' END AS vision_support,
    input_price_per_1m AS input_price, output_price_per_1m AS output_price FROM totals""",
    "compare_rank": TOTALS + """ SELECT row_number() OVER (ORDER BY total_cost, ord) AS rank,
    model, total_cost, avg_cost_per_conversation AS cost_per_conv,
    total_conversations AS conversations FROM totals""",
    "compare_multiplier": TOTALS + """, ranked AS (SELECT *,
    row_number() OVER (ORDER BY total_cost, ord) AS rank FROM totals)
    SELECT r.model, c.model AS cheapest_model, (r.total_cost / r.total_conversations)
      / (c.total_cost / c.total_conversations) AS multiplier, r.rank
    FROM ranked r CROSS JOIN (SELECT * FROM ranked WHERE rank = 1) c""",
    "compare_vs_cheapest_total": TOTALS + """ SELECT model, total_cost,
    total_cost / min(total_cost) OVER () AS vs_cheapest FROM totals""",
    "last_result_wins": DATASET_TOTALS + """ SELECT model, ascii('a')::BIGINT AS input_ord,
    total_conversations, total_input_tokens FROM totals WHERE dataset = 'c'""",
    "cost_estimate": TOTALS + f""" SELECT m.model, a.avg_total_input_tokens AS avg_input_tokens,
    {OUTPUT_TOKENS}::BIGINT AS output_tokens, a.avg_total_input_tokens / 1e6::DOUBLE * m.in_rate
      + {OUTPUT_TOKENS} / 1e6::DOUBLE * m.out_rate AS cost_per_conversation
    FROM (SELECT * FROM totals WHERE model = 'gpt-4o') a CROSS JOIN models m""",
    "summary_report": _report(),
    "keyless_row_usage": ROW_USAGE + " SELECT * EXCLUDE (task_id, prefix_len) FROM usage",
    "first_n_filtered_usage": ROW_USAGE + f""" SELECT u.* FROM usage u JOIN (
      SELECT s.task_id, s.pos + 1 AS prefix_len FROM steps s
      JOIN tasks t ON t.task_id = s.task_id {KEPT} AND s.pos >= 1 ORDER BY 1, 2 LIMIT 25) f
    ON f.task_id = u.task_id AND f.prefix_len = u.prefix_len WHERE u.model = 'gpt-5'""",
    "totals_with_failures": _totals(usage=FAILING_USAGE) + SUMMED,
    "row_totals_with_failures": _totals(usage=FAILING_USAGE) + SUMMED,
    "full_only_totals": _totals("", f"""JOIN {LENGTHS} l ON l.task_id = u.task_id
    AND l.n = u.prefix_len AND l.n > 3""") + SUMMED,
    "late_prefix_totals": _totals("", "AND u.prefix_len > 2") + SUMMED,
    "documented_usage": DOCUMENTED_USAGE + " SELECT * FROM usage",
    "documented_totals": _totals(usage=DOCUMENTED_USAGE) + SUMMED,
    "other_output_tokens": ROW_USAGE + f""" SELECT u.task_id, u.prefix_len, u.model, text_tokens,
    image_tokens, image_count, total_input_tokens, 100::BIGINT AS output_tokens,
    total_input_tokens + 100 AS total_tokens, input_cost, 100 / 1e6::DOUBLE * m.out_rate
    AS output_cost, input_cost + 100 / 1e6::DOUBLE * m.out_rate AS total_cost
    FROM usage u JOIN models m ON m.model = u.model JOIN {LENGTHS} l
    ON l.task_id = u.task_id AND l.n = u.prefix_len""",
    "usage_without_vision": ALL_USAGE.replace(MODEL_ROWS, BLIND_ROWS),
    "combined_results": DATASET_TOTALS + """ SELECT model, 0::BIGINT AS input_ord,
    total_conversations, total_tokens FROM totals WHERE dataset = 'b'""",
    "file_labels": """SELECT doc_id, CASE WHEN lang IN ('en', 'de') THEN source
    ELSE source || '_tokens_v2.json' END AS model FROM documents""",
    "parsed_trajectories": f"""WITH {STEPS}, {TASKS} SELECT s.task_id, t.alignment_score, s.pos,
    s.image, s.action FROM steps s JOIN tasks t ON t.task_id = s.task_id""",
    "parsed_training_rows": f"""WITH {STEPS}, {TASKS}, {PREFIXES}, {HISTORY}, {_messages("L2")}
    SELECT * FROM messages""",
    "parsed_result_sets": TOTALS + SUMMED,
    "image_changes": f"""WITH {STEPS}, files AS (SELECT image AS path, task_id * 31 + pos AS n
      FROM steps) SELECT path, CASE WHEN n % 5 = 0 THEN 'deleted' WHEN n % 4 = 0 THEN 'new'
      WHEN n % 9 = 0 OR n % 7 = 0 THEN 'changed' ELSE 'unchanged' END AS change
    FROM files WHERE n % 5 > 0 OR n % 4 > 0""",
    "png_header_dims": f"""WITH {DIMS} SELECT path, status,
    CASE WHEN status = 'ok' THEN width ELSE 0 END AS width,
    CASE WHEN status = 'ok' THEN height ELSE 0 END AS height FROM dims""",
}
# What is written and read back is the result itself.
ORACLE.update({
    "written_training_rows": ORACLE["parsed_training_rows"],
    "array_training_rows": ORACLE["parsed_training_rows"],
    "written_usage": ORACLE["conversation_usage"],
    "written_usage_csv": ORACLE["conversation_usage"],
    "discovered_result_sets": ORACLE["parsed_result_sets"],
})
