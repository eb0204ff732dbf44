"""The same results in standard SQL, for checking."""

from __future__ import annotations

from seqprep.plans.catalog import (
    BATCH,
    BLOCK,
    EPOCHS,
    EVAL_BATCH,
    LOG_STEPS,
    LONG_LABEL_BLOCK,
    NO_LOG_STEPS,
    RUN_STEPS,
    SEED,
    TOKENS_BLOCK,
    SKETCH_VOCAB,
    VOCAB,
)
from seqprep.plans.inputs import STOP_TOKENS
from seqprep.plans.run_parameters import RUN_PARAMETERS

ORACLE_SQL: dict[str, str] = {}

# --- sources, splits ------------------------------------------------------------------------

_PLACED = """
placed AS (SELECT *, row_number() OVER (ORDER BY {key}) - 1 AS pos, count(*) OVER () AS n
           FROM {table})"""


def _bound(percent: int) -> str:
    return f"round_even(n * {percent} / 100.0, 0)"


_DOCS = "WITH" + _PLACED.format(key="doc_id", table="documents")
_FRONT = f"CASE WHEN pos < {_bound(5)} THEN 'validation' ELSE 'train' END"
_MIDDLE = f"CASE WHEN pos < {_bound(90)} THEN 'train' ELSE 'validation' END"

ORACLE_SQL["read_dataset"] = f"""
{_DOCS} SELECT doc_id, {_FRONT} AS split, source AS instruction, text AS response FROM placed"""
ORACLE_SQL["read_published_split"] = """
WITH train AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n
  FROM documents WHERE doc_id % 5 <> 0)
SELECT doc_id, CASE WHEN pos < round_even(n * 90 / 100.0, 0) THEN 'train' ELSE 'validation' END AS split
FROM train WHERE pos < round_even(n * 95 / 100.0, 0)"""
ORACLE_SQL["running_sum_null_groups"] = """
WITH e AS (SELECT event_id, nullif(user_id % 7, 0) AS g FROM events)
SELECT event_id, g, row_number() OVER (PARTITION BY g ORDER BY event_id) AS place,
  count(*) OVER (PARTITION BY g) AS places FROM e"""
ORACLE_SQL["pct_front_split"] = f"{_DOCS} SELECT doc_id, {_FRONT} AS split FROM placed"
ORACLE_SQL["materialised_split"] = ORACLE_SQL["pct_front_split"]
ORACLE_SQL["materialised_split_reused"] = ORACLE_SQL["pct_front_split"]
ORACLE_SQL["pct_middle_split"] = f"""
{_DOCS} SELECT doc_id, {_MIDDLE} AS split FROM placed WHERE pos < {_bound(95)}"""
ORACLE_SQL["pct_slice"] = f"""
WITH {_PLACED.format(key="conv_id, turn", table="conversations")}
SELECT conv_id, turn, text FROM placed WHERE pos >= {_bound(25)} AND pos < {_bound(75)}"""


def _sliced(columns: str, table: str, order: str, low: int, high: int) -> str:
    return f"""
WITH placed AS (
  SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS pos, count(*) OVER () AS n FROM {table})
SELECT {columns} FROM placed WHERE pos >= {_bound(low)} AND pos < {_bound(high)}"""


ORACLE_SQL["pct_slice_ties"] = _sliced("doc_id, lang, source", "documents", "lang NULLS FIRST, doc_id", 5, 60)
ORACLE_SQL["pct_slice_by_time"] = _sliced("event_id, user_id", "events", "ts NULLS FIRST, event_id", 10, 25)
ORACLE_SQL["pct_slice_by_decimal"] = _sliced(
    "l_orderkey, l_linenumber, price::DOUBLE AS price",
    "(SELECT *, l_extendedprice::DECIMAL(18, 2) AS price FROM lineitem)",
    "price, l_orderkey, l_linenumber",
    40,
    55,
)
ORACLE_SQL["pct_slice_ties_by_content"] = f"""
WITH placed AS (
  SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag) - 1 AS pos, count(*) OVER () AS n
  FROM lineitem)
SELECT l_returnflag, {_MIDDLE} AS split, count(*) AS rows
FROM placed WHERE pos < {_bound(95)} GROUP BY 1, 2"""
ORACLE_SQL["read_csv_split"] = f"""
{_DOCS} SELECT doc_id, {_MIDDLE} AS split, source AS instruction,
  translate(text, chr(13) || chr(10), '  ') AS response
FROM placed WHERE pos < {_bound(95)}"""
ORACLE_SQL["split_dictionary"] = f"""
SELECT split, count(*) AS rows, min(doc_id) AS first_id, max(doc_id) AS last_id
FROM ({ORACLE_SQL["pct_middle_split"]}) GROUP BY split"""

# --- row shaping ----------------------------------------------------------------------------

_PAIRS = """
pairs AS (
  SELECT conv_id, turn, text AS instruction, next_text AS response
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""
_PAIR_TEXT = "'<reserved_102>' || instruction || '<reserved_103>' || response || '</s>'"
_TURN_TEXT = """string_agg(CASE role WHEN 'system' THEN text
  WHEN 'user' THEN '<reserved_102>' || text
  WHEN 'assistant' THEN '<reserved_103>' || text ELSE '' END, '' ORDER BY turn)"""

ORACLE_SQL["instruction_pairs"] = f"WITH {_PAIRS} SELECT * FROM pairs"
ORACLE_SQL["map_roles"] = "SELECT doc_id, source AS instruction, text AS response FROM documents"
ORACLE_SQL["pair_messages"] = f"""
WITH {_PAIRS}
SELECT conv_id, turn, to_json([{{'role': 'user', 'content': instruction}},
  {{'role': 'assistant', 'content': response}}])::VARCHAR AS messages FROM pairs"""
ORACLE_SQL["plain_prompt"] = f"""
WITH {_PAIRS}
SELECT conv_id, turn, '##INSTRUCTION ' || instruction || chr(10) || chr(10) || '##RESPONSE '
  || coalesce(CASE WHEN conv_id % 7 <> 0 THEN response END, 'None') AS text FROM pairs"""
ORACLE_SQL["render_pairs"] = f"WITH {_PAIRS} SELECT conv_id, turn, {_PAIR_TEXT} AS text FROM pairs"
ORACLE_SQL["render_conversations"] = f"""
SELECT conv_id, part, {_TURN_TEXT} AS text FROM (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 1024 AS part FROM conversations)
GROUP BY ALL"""
ORACLE_SQL["render_generation"] = f"""
SELECT conv_id, part, text || CASE WHEN part = max(part) OVER (PARTITION BY conv_id)
  THEN '<reserved_107>' ELSE '' END AS text FROM ({ORACLE_SQL["render_conversations"]})"""
ORACLE_SQL["route_first_match"] = """
SELECT doc_id,
  CASE WHEN source LIKE '%src10%' THEN 'ten'
       WHEN source LIKE '%src1%' AND source NOT LIKE '%src12%' THEN 'one'
       WHEN source LIKE '%src2%' THEN 'two' ELSE 'other' END AS label,
  CASE WHEN lang = 'en' THEN 'auto' ELSE 'qwen' END AS architecture, 'c_proj' AS adapted,
  CASE WHEN lang = 'en' THEN 'cast' ELSE 'keep' END AS precision,
  CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' END AS language
FROM documents"""
ORACLE_SQL["map_rows"] = """
SELECT doc_id, length(text)::BIGINT AS chars,
  (length(text) - length(replace(text, chr(10), '')))::BIGINT AS lines FROM documents"""
ORACLE_SQL["scalar_functions"] = """
WITH timed AS (
  SELECT *, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6 AS since FROM events)
SELECT event_id, since, floor(since / 86400)::BIGINT AS days,
  since - floor(since / 86400) * 86400 AS rest,
  (event_id + 1) * (user_id + 1) * 2 AS elements,
  string_split(props, ':')[-1] AS last_part,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS named_time,
  strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS seoul_time
FROM timed"""

# --- vocabulary, sequences ------------------------------------------------------------------

_TOKEN = r"[a-z0-9]+|[^a-z0-9\s]"


def _ids(source: str, key: str, pattern: str, specials: list[str], block: int) -> str:
    """``vocab`` and ``encoded`` (key, ids) of a source with a text column."""
    fixed = ", ".join(f"('{tok}', {i})" for i, tok in enumerate(specials))
    listed = ", ".join(f"'{tok}'" for tok in specials)
    return f"""
lists AS (SELECT {key}, regexp_extract_all(lower(text), '{pattern}') AS l FROM {source}),
tokens AS (SELECT {key}, unnest(l) AS tok, generate_subscripts(l, 1) AS i FROM lists),
vocab AS (
  SELECT tok, row_number() OVER (ORDER BY count(*) DESC, tok) + {len(specials) - 1} AS id
  FROM tokens WHERE tok NOT IN ({listed}) GROUP BY tok
  QUALIFY row_number() OVER (ORDER BY count(*) DESC, tok) <= {VOCAB}
  UNION ALL SELECT * FROM (VALUES {fixed})),
found AS (
  SELECT {key}, list(coalesce(id, 1)::BIGINT ORDER BY i) AS ids
  FROM tokens LEFT JOIN vocab USING (tok) WHERE i <= {block} GROUP BY ALL),
encoded AS (
  SELECT {key}, coalesce(ids, []::BIGINT[]) AS ids FROM lists LEFT JOIN found USING ({key}))"""


def _flat(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


def _doc_ids(block: int) -> str:
    return "WITH " + _ids("documents", "doc_id", _TOKEN, ["<pad>", "<unk>", "</s>"], block)


def _ones(block: int) -> str:
    return f"list_resize([1 FOR x IN ids], {block}, 0)"


_ENCODED = _doc_ids(BLOCK)
_POSITIONS = _flat(f"range({BLOCK})")
_FILLED = f"{_ENCODED}, filled AS (SELECT doc_id, list_resize(ids, {BLOCK}, 3) AS ids FROM encoded)"

ORACLE_SQL["build_vocab"] = f"{_ENCODED} SELECT tok, id::BIGINT AS id FROM vocab"
ORACLE_SQL["build_vocab_sketch"] = f"{ORACLE_SQL['build_vocab']} WHERE id < {SKETCH_VOCAB + 3}"
ORACLE_SQL["encode_pad"] = f"""
{_ENCODED} SELECT doc_id, {_flat(f"list_resize(ids, {BLOCK}, 0)")} AS input_ids FROM encoded"""
ORACLE_SQL["encode_join"] = f"{_ENCODED} SELECT doc_id, {_flat('ids')} AS ids FROM encoded"
ORACLE_SQL["encode_join_salted"] = ORACLE_SQL["encode_join"]
ORACLE_SQL["pad_left"] = f"""
{_doc_ids(LONG_LABEL_BLOCK)}
SELECT doc_id,
  {_flat(f"list_reverse(list_resize(list_reverse(ids), {LONG_LABEL_BLOCK}, 0))")} AS input_ids,
  {_flat(f"list_reverse({_ones(LONG_LABEL_BLOCK)})")} AS attention_mask
FROM encoded"""
ORACLE_SQL["truncate"] = f"""
{_ENCODED} SELECT doc_id, {_flat(f"ids[1:{LONG_LABEL_BLOCK}]")} AS ids FROM encoded"""
ORACLE_SQL["length_mask"] = f"""
{_ENCODED} SELECT doc_id, {_flat(_ones(BLOCK))} AS attention_mask FROM encoded"""
ORACLE_SQL["value_mask"] = f"""
{_FILLED} SELECT doc_id, {_flat("[(x <> 3)::INT FOR x IN ids]")} AS attention_mask FROM filled"""
ORACLE_SQL["mask_labels"] = f"""
{_FILLED} SELECT doc_id,
  {_flat("[CASE WHEN x <> 3 THEN x ELSE -100 END FOR x IN ids]")} AS labels FROM filled"""
ORACLE_SQL["copy_labels_positions"] = f"""
{_FILLED} SELECT doc_id, {_flat("ids")} AS labels, {_POSITIONS} AS position_ids FROM filled"""
ORACLE_SQL["project_sequence"] = f"""
{_ENCODED} SELECT doc_id, {_flat(f"list_resize(ids, {BLOCK}, 0)")} AS input_ids,
  {_flat(_ones(BLOCK))} AS attention_mask, {_POSITIONS} AS position_ids FROM encoded"""

_MARKS = ["<pad>", "<unk>", "</s>", "<reserved_102>", "<reserved_103>"]
_MARKED_TOKEN = "<reserved_102>|<reserved_103>|</s>|" + _TOKEN
_PREPARED = f"""
WITH {_PAIRS}, {_PLACED.format(key="conv_id, turn", table="pairs")},
texts AS (SELECT conv_id, turn, {_MIDDLE} AS split, {_PAIR_TEXT} AS text
          FROM placed WHERE pos < {_bound(95)}),
{_ids("texts", "conv_id, turn, split", _MARKED_TOKEN, _MARKS, BLOCK)}"""
ORACLE_SQL["prepared_sequences"] = f"""
{_PREPARED}
SELECT conv_id, turn, split, {_flat(f"list_resize(ids, {BLOCK}, 0)")} AS input_ids,
  {_flat(_ones(BLOCK))} AS attention_mask, {_flat(f"list_resize(ids, {BLOCK}, 0)")} AS labels,
  {_POSITIONS} AS position_ids
FROM encoded"""

# --- epochs, batches ------------------------------------------------------------------------

_EPOCHS = f"epochs AS (SELECT doc_id, epoch FROM documents, range({EPOCHS}) AS r(epoch))"
_SHUFFLED = f"""
{_EPOCHS},
shuffled AS (
  SELECT doc_id, epoch::INT AS epoch, count(*) OVER (PARTITION BY epoch) AS n,
    row_number() OVER (PARTITION BY epoch ORDER BY md5('{SEED}:' || epoch || ':' || doc_id), doc_id)
      - 1 AS pos
  FROM epochs)"""

ORACLE_SQL["with_epochs"] = f"WITH {_EPOCHS} SELECT doc_id, epoch::INT AS epoch FROM epochs"
ORACLE_SQL["epoch_shuffle"] = f"WITH {_SHUFFLED} SELECT doc_id, epoch, pos FROM shuffled"
ORACLE_SQL["epoch_batches"] = f"""
WITH {_SHUFFLED}
SELECT doc_id, epoch, pos // {BATCH} AS batch_id, pos % {BATCH} AS slot,
  epoch * (n // {BATCH}) + pos // {BATCH} + 1 AS step
FROM shuffled WHERE pos // {BATCH} < n // {BATCH}"""
ORACLE_SQL["batch_drop_last"] = f"""
{_DOCS} SELECT doc_id, pos // {BATCH} AS batch_id, pos % {BATCH} AS slot
FROM placed WHERE pos // {BATCH} < n // {BATCH}"""
ORACLE_SQL["batch_max_steps"] = f"""
SELECT * FROM ({ORACLE_SQL["batch_drop_last"]}) WHERE batch_id < 10"""
ORACLE_SQL["batch_keep_last"] = f"""
WITH {_PLACED.format(key="conv_id, turn", table="conversations")}
SELECT conv_id, turn, pos // {BATCH} AS batch_id, pos % {BATCH} AS slot FROM placed"""
ORACLE_SQL["train_steps"] = f"""
SELECT count(*) AS rows, count(*) // {BATCH} AS batches, count(*) // {BATCH} * {EPOCHS} AS steps
FROM documents"""

ORACLE_SQL["train_steps_longer"] = f"""
SELECT count(*) AS rows, count(*) // {BATCH} AS batches,
  CASE WHEN count(*) >= {BATCH} THEN 100000 ELSE 0 END::BIGINT AS steps FROM documents"""
ORACLE_SQL["eval_batches"] = f"""
{_DOCS} SELECT doc_id, pos // {EVAL_BATCH} AS batch_id, pos % {EVAL_BATCH} AS slot
FROM placed
WHERE pos < {_bound(5)} AND pos // {EVAL_BATCH} < {_bound(5)}::BIGINT // {EVAL_BATCH}"""
ORACLE_SQL["training_batches"] = f"""
{_PREPARED},
repeated AS (
  SELECT conv_id, turn, epoch, ids FROM encoded, range({EPOCHS}) AS r(epoch)
  WHERE split = 'train'),
shuffled AS (
  SELECT conv_id, turn, epoch::INT AS epoch, ids, count(*) OVER (PARTITION BY epoch) AS n,
    row_number() OVER (PARTITION BY epoch ORDER BY
      md5('{SEED}:' || epoch || ':' || conv_id || ':' || turn), conv_id, turn) - 1 AS pos
  FROM repeated)
SELECT conv_id, turn, epoch, pos // {EVAL_BATCH} AS batch_id, pos % {EVAL_BATCH} AS slot,
  epoch * (n // {EVAL_BATCH}) + pos // {EVAL_BATCH} + 1 AS step,
  {_flat(f"list_resize(ids, {BLOCK}, 0)")} AS input_ids
FROM shuffled WHERE pos // {EVAL_BATCH} < n // {EVAL_BATCH}"""

# --- run reports ----------------------------------------------------------------------------

_PRESETS = ", ".join(f"({i}, {row[1]}, {row[5]!r}::DOUBLE)" for i, row in enumerate(RUN_PARAMETERS))
_RUNS = f"""
ordered AS (
  SELECT user_id AS run_id, event_id AS seq, epoch_us(ts) AS us, ts, event_type, value,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
    count(*) OVER (PARTITION BY user_id) AS n
  FROM events),
kinds AS (
  SELECT *, CASE WHEN rn = 1 THEN 'begin' WHEN rn = n THEN 'evaluate'
    WHEN rn = n - 1 THEN 'epoch_end' WHEN event_type = 'signup' THEN 'eval_log'
    ELSE 'step' END AS kind FROM ordered),
runs AS (
  SELECT run_id, seq, us, ts, kind, CASE WHEN kind = 'step' THEN value END AS loss, train_batch, lr,
    (sum((kind = 'step')::INT) OVER (PARTITION BY run_id ORDER BY us, seq))::BIGINT AS step
  FROM kinds JOIN (VALUES {_PRESETS}) AS p(preset, train_batch, lr)
    ON run_id % {len(RUN_PARAMETERS)} = preset)"""


def _timed(logging_steps: int, batch: str) -> str:
    return f"""
clock AS (
  SELECT *, lag(us) OVER w AS before_us, lag(step) OVER w AS before_step
  FROM runs
  WHERE kind IN ('begin', 'eval_log')
     OR kind = 'step' AND (step % {logging_steps} = 0 OR step = 1)
  WINDOW w AS (PARTITION BY run_id ORDER BY us, seq)),
intervals AS (
  SELECT run_id, seq, step, loss, lr, step - before_step AS steps, us - before_us AS span,
    (us - before_us) / 1e6 AS seconds,
    ({TOKENS_BLOCK}::DOUBLE * {batch} * (step - before_step)) / nullif((us - before_us) / 1e6, 0)
      AS tps,
    ((us - before_us) / 1e6) / nullif((step - before_step)::DOUBLE, 0) AS seconds_per_step
  FROM clock WHERE loss IS NOT NULL AND step <> 1 AND kind = 'step')"""


def _intervals(batch: str) -> str:
    return f"""
WITH {_RUNS}, {_timed(LOG_STEPS, batch)}
SELECT run_id, seq, step, loss, steps, seconds, tps, seconds_per_step FROM intervals"""


def _measured(logging_steps: int, batch: str) -> str:
    return f"""
WITH {_RUNS}, {_timed(logging_steps, batch)},
per_event AS (
  SELECT run_id, min(us) FILTER (WHERE kind = 'begin') AS begin_us,
    max(us) FILTER (WHERE kind = 'epoch_end') AS epoch_end,
    max(us) FILTER (WHERE kind = 'evaluate') AS evaluate,
    max(us) AS last_us, max(step) AS last_step, max(train_batch) AS train_batch
  FROM runs GROUP BY run_id),
per_clock AS (
  SELECT run_id, max(us) AS clock_us, arg_max(step, struct_pack(a := us, b := seq)) AS clock_step,
    arg_max(us - before_us, struct_pack(a := us, b := seq))
      FILTER (WHERE step = 1 AND kind <> 'begin') AS warm
  FROM clock GROUP BY run_id),
per_interval AS (
  SELECT run_id, count(*) AS c, avg(tps) AS tps, sum(span) AS span
  FROM intervals GROUP BY run_id),
measured AS (
  SELECT run_id, coalesce(c, 0) AS intervals,
    CASE WHEN c IS NULL THEN ({TOKENS_BLOCK}::DOUBLE * {batch} * (last_step - clock_step))
      / nullif((last_us - clock_us) / 1e6, 0) ELSE i.tps END AS avg_tps,
    (coalesce(span, last_us - clock_us) / 1e6)
      / nullif((coalesce(c, 1) * {logging_steps} - 1)::DOUBLE, 0) AS avg_step_seconds,
    warm / 1e6 AS warm_up_seconds,
    (epoch_end - begin_us) / 1e6 AS train_seconds,
    coalesce((evaluate - epoch_end) / 1e6, 0) AS eval_seconds
  FROM per_event LEFT JOIN per_clock USING (run_id) LEFT JOIN per_interval i USING (run_id))"""


def _summary(logging_steps: int) -> str:
    return f"""
{_measured(logging_steps, "train_batch")}
SELECT run_id, intervals, round(avg_tps, 6) AS avg_tps,
  avg_step_seconds, warm_up_seconds, train_seconds, eval_seconds,
  train_seconds + warm_up_seconds + eval_seconds AS total_seconds
FROM measured"""


ORACLE_SQL["logged_steps"] = f"""
WITH {_RUNS} SELECT run_id, seq, step, loss FROM runs
WHERE kind = 'step' AND (step % {LOG_STEPS} = 0 OR step = 1)"""
ORACLE_SQL["present_loss"] = f"""
WITH {_RUNS} SELECT run_id, seq, loss FROM runs WHERE loss IS NOT NULL"""
ORACLE_SQL["interval_throughput"] = _intervals("train_batch")
ORACLE_SQL["run_summary"] = _summary(LOG_STEPS)
ORACLE_SQL["run_summary_by_days"] = ORACLE_SQL["run_summary"]
ORACLE_SQL["run_summary_no_interval"] = _summary(NO_LOG_STEPS)
ORACLE_SQL["run_eta"] = f"""
{_measured(LOG_STEPS, "train_batch")},
estimated AS (
  SELECT run_id, warm_up_seconds + avg_step_seconds * ({RUN_STEPS} - 1) + warm_up_seconds
    + {EPOCHS} * eval_seconds AS s FROM measured)
SELECT run_id, s AS estimated_seconds, floor(s / 86400)::BIGINT AS estimated_days,
  s - floor(s / 86400) * 86400 AS estimated_rest_seconds FROM estimated"""
ORACLE_SQL["run_log_files"] = f"""
WITH {_RUNS}, {_timed(LOG_STEPS, "train_batch")},
started AS (SELECT run_id, ts FROM runs WHERE kind = 'begin'),
lines AS (
  SELECT run_id, 'step' AS kind, step, loss, NULL AS label FROM intervals
  UNION ALL
  SELECT run_id, 'summary', NULL, NULL, label
  FROM started, (VALUES ('Total Duration'), ('Model Loading Duration'), ('Train Duration'),
    ('Evaluation Duration'), ('Total Estimated Duration'), ('Avg TPS')) AS l(label))
SELECT run_id, strftime(ts, '%y%m%d_%H%M%S') AS log,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS started, kind, step, loss, label
FROM lines JOIN started USING (run_id)"""


def _written(value: str, digits: int) -> str:
    """A number as the log lines round it: its shortest decimal form, halves away from zero."""
    return f"round(({value})::VARCHAR::DECIMAL(38, 18), {digits})::DOUBLE"


_FIGURES = ", ".join(
    f"{_written(value, digits)} AS {name}"
    for name, value, digits in (
        ("tps", "tps", 2),
        ("loss", "loss", 6),
        ("learning_rate", "coalesce(lr, 0)", 8),
        ("seconds_per_step", "seconds_per_step", 2),
    )
)
ORACLE_SQL["run_log_roundtrip"] = f"""
{_measured(LOG_STEPS, "train_batch")},
started AS (SELECT run_id, ts FROM runs WHERE kind = 'begin'),
report AS (
  SELECT *, train_seconds + warm_up_seconds + eval_seconds AS total_seconds,
    warm_up_seconds + avg_step_seconds * ({RUN_STEPS} - 1) + warm_up_seconds + {EPOCHS} * eval_seconds AS estimated
  FROM measured),
labels AS (
  SELECT run_id, unnest(['Total Duration', 'Model Loading Duration', 'Train Duration', 'Evaluation Duration', 'Avg TPS'])
      AS label,
    unnest([total_seconds, warm_up_seconds, train_seconds, eval_seconds, avg_tps]) AS value
  FROM report),
lines AS (
  SELECT run_id, 'step' AS kind, step, {_FIGURES}, NULL AS label, NULL::DOUBLE AS value FROM intervals
  UNION ALL
  SELECT run_id, 'summary', NULL, NULL, NULL, NULL, NULL, label, {_written("value", 2)} FROM labels
  UNION ALL
  SELECT run_id, 'summary', NULL, NULL, NULL, NULL, NULL, 'Total Estimated Duration',
    round(floor(estimated / 86400) * 86400
      + round((estimated - floor(estimated / 86400) * 86400) * 1000000) / 1000000, 6)
  FROM report)
SELECT run_id, strftime(ts, '%y%m%d_%H%M%S') AS log, strftime(ts, '%Y-%m-%d %H:%M:%S') AS started,
  kind, step, tps, loss, learning_rate, seconds_per_step, label, value
FROM lines JOIN started USING (run_id)"""
ORACLE_SQL["stream_throughput"] = _intervals(str(BATCH))
ORACLE_SQL["stream_throughput_by_record"] = ORACLE_SQL["stream_throughput"]
ORACLE_SQL["stream_late_records"] = ORACLE_SQL["stream_throughput"]
ORACLE_SQL["stream_summary_incremental"] = ORACLE_SQL["run_summary"]
ORACLE_SQL["stream_summary"] = f"""
WITH {_RUNS}, {_timed(LOG_STEPS, str(BATCH))}
SELECT run_id, count(*) AS intervals, round(avg(tps), 6) AS avg_tps,
  (sum(span) / 1e6) / nullif((count(*) * {LOG_STEPS} - 1)::DOUBLE, 0) AS avg_step_seconds
FROM intervals GROUP BY run_id"""

# --- aggregates, records --------------------------------------------------------------------

ORACLE_SQL["flagged_share"] = """
SELECT l_linestatus, sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS flagged,
  sum(l_quantity) AS total,
  100 * sum(l_quantity) FILTER (WHERE l_returnflag = 'R') / sum(l_quantity) AS percent
FROM lineitem GROUP BY l_linestatus"""
ORACLE_SQL["flagged_share_total"] = """
WITH sized AS (SELECT (l_linenumber * l_quantity::BIGINT)::BIGINT AS v, l_linestatus FROM lineitem)
SELECT sum(v) FILTER (WHERE l_linestatus = 'F')::BIGINT AS flagged, sum(v)::BIGINT AS total,
  (100 * sum(v) FILTER (WHERE l_linestatus = 'F'))::DOUBLE / sum(v)::DOUBLE AS percent
FROM sized"""
ORACLE_SQL["chat_requests"] = """
SELECT conv_id, 0::BIGINT AS part, 1::BIGINT AS parts,
  to_json({'model': 'assistant-model',
           'messages': list({'role': role, 'content': text} ORDER BY turn),
           'max_tokens': 200})::VARCHAR AS body
FROM conversations GROUP BY conv_id"""
_RESPONSES = f"""
{_PAIRS},
counted AS (
  SELECT *, length(regexp_split_to_array(trim(instruction), '\\s+'))::BIGINT AS p,
    length(regexp_split_to_array(trim(response), '\\s+'))::BIGINT AS c,
    'model-' || (conv_id % 3) AS model FROM pairs),
responses AS (
  SELECT *, CASE WHEN c <= {STOP_TOKENS} THEN 'stop' ELSE 'length' END AS finish_reason
  FROM counted)"""
ORACLE_SQL["chat_responses"] = f"""
WITH {_RESPONSES}
SELECT conv_id, turn, 'chatcmpl-' || conv_id || '-' || turn AS id,
  'chat.completion' AS object, turn AS created, model, 0 AS choice, 'assistant' AS role,
  NULL::VARCHAR AS reasoning_content, response AS content, 0 AS tool_calls,
  NULL::VARCHAR AS logprobs, finish_reason, NULL::VARCHAR AS stop_reason, p AS prompt_tokens,
  c AS completion_tokens, p + c AS total_tokens, NULL::VARCHAR AS prompt_tokens_details,
  NULL::VARCHAR AS prompt_logprobs
FROM responses"""
ORACLE_SQL["chat_responses_any"] = f"""
WITH {_RESPONSES}
SELECT conv_id, turn, 'chatcmpl-' || conv_id || '-' || turn AS id, model, 0 AS choice, response AS content,
  finish_reason, p + c AS total_tokens, 'call-' || turn AS call_id, 'look_up' AS call_name, conv_id AS seed
FROM responses WHERE (conv_id + turn) % 7 <> 0"""
ORACLE_SQL["chat_responses_broken"] = f"""
WITH {_RESPONSES}
SELECT conv_id, turn, substr('{{"extra":{{"seed":' || conv_id || '}},"id":"chatcmpl-' || conv_id || '-' || turn
  || '","object":"chat.completion"', 1, 40) AS body
FROM responses WHERE (conv_id + turn) % 7 = 0"""
ORACLE_SQL["usage_rollup"] = f"""
WITH {_RESPONSES}
SELECT model, finish_reason, count(*) AS responses, sum(p)::BIGINT AS prompt_tokens,
  sum(c)::BIGINT AS completion_tokens, sum(p + c)::BIGINT AS total_tokens,
  count(*) AS consistent
FROM responses GROUP BY ALL"""
