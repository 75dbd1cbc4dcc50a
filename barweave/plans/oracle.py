"""SQL with the same answers as the registered queries, for a check by another engine."""

_SUPPLIER = """supplier_bars AS (
  SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date,
         arg_min(l_extendedprice, ROW(l_orderkey, l_linenumber, l_extendedprice)) AS open,
         max(l_extendedprice) AS high, min(l_extendedprice) AS low,
         arg_max(l_extendedprice, ROW(l_orderkey, l_linenumber, l_extendedprice)) AS close,
         sum(l_quantity) AS volume
  FROM lineitem GROUP BY 1, 2)"""

_EVENT = """event_bars AS (
  SELECT event_type AS symbol, CAST(ts AS DATE) AS date,
         arg_min(value, ROW(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ROW(ts, event_id)) AS close, count(*) AS volume
  FROM events GROUP BY 1, 2)"""

_TICKS = """ticks AS (
  SELECT user_id AS symbol, ts, event_id AS seq, value AS price FROM events)"""

_TYPED = """ticks AS (
  SELECT event_type AS symbol, ts, event_id AS seq, value AS price FROM events)"""


def _derived(price: str, by: str) -> str:
    w = f"PARTITION BY symbol ORDER BY {by}"
    return f"""
    round(avg({price}) OVER ({w} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS sma5,
    round(avg({price}) OVER ({w} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS sma10,
    coalesce({price} / nullif(lag({price}, 1) OVER ({w}), 0) - 1, 0) AS ret1,
    coalesce({price} / nullif(lag({price}, 5) OVER ({w}), 0) - 1, 0) AS ret5,
    coalesce(CAST(lead({price}) OVER ({w}) > {price} AS INTEGER), 0) AS target"""


_PRICES = "open, high, low, close, volume"
_FEATURES = ["open", "high", "low", "close", "volume", "sma5", "sma10", "ret1", "ret5"]

_FEAT = f"""{_SUPPLIER},
feat AS (SELECT symbol, date, {_PRICES}, {_derived('close', 'date')} FROM supplier_bars)"""

_PLACED = f"""{_FEAT},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS place,
         count(*) OVER (PARTITION BY symbol) AS n FROM feat)"""

_GAPPED = f"""{_FEAT},
gapped AS (
  SELECT * REPLACE (CASE WHEN day(date) % 5 <> 0 THEN close END AS close,
                    CASE WHEN day(date) % 3 <> 0 THEN sma5 END AS sma5,
                    CASE WHEN day(date) % 3 <> 0 THEN ret5 END AS ret5) FROM feat)"""

_WIDE = f"""{_FEAT},
wide AS (
  SELECT symbol, date, target, CAST(close > sma5 AS INTEGER) AS lr_pred,
         CAST(ret1 > 0 AS INTEGER) AS rf_pred, CAST(ret5 > 0 AS INTEGER) AS gbt_pred FROM feat)"""

_LONG = f"""{_WIDE},
predictions AS (
  SELECT symbol, date, target AS actual, 'lr' AS model, lr_pred AS predicted FROM wide
  UNION ALL SELECT symbol, date, target, 'rf', rf_pred FROM wide
  UNION ALL SELECT symbol, date, target, 'gbt', gbt_pred FROM wide)"""

_TEST = ", test AS (SELECT * FROM placed WHERE place > floor(n * CAST(0.9 AS DOUBLE))) "

_BROKEN = "(symbol + dayofyear(date)) % 17 = 0"

_TITLE = """CASE model WHEN 'lr' THEN 'Logistic Regression' WHEN 'rf' THEN 'Random Forest'
     WHEN 'gbt' THEN 'Gradient Boosted Trees' END AS model"""


_F1 = "coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)"


def _digits(expression: str, digits: int | None, name: str = "") -> str:
    shown = expression if digits is None else f"round({expression}, {digits})"
    return f"{shown} AS {name or expression}"


def _binary(keys: str, digits: int | None) -> str:
    return f"""counts AS (
  SELECT {keys}, CAST(count(*) AS DOUBLE) AS n,
         CAST(sum(CAST(actual = predicted AS INTEGER)) AS DOUBLE) AS hit,
         CAST(sum(CAST(actual = 1 AND predicted = 1 AS INTEGER)) AS DOUBLE) AS tp,
         CAST(sum(CAST(predicted = 1 AS INTEGER)) AS DOUBLE) AS pp,
         CAST(sum(CAST(actual = 1 AS INTEGER)) AS DOUBLE) AS ap
  FROM predictions GROUP BY {keys}),
parts AS (
  SELECT {keys}, hit / n AS accuracy, coalesce(tp / nullif(pp, 0), 0) AS precision,
         coalesce(tp / nullif(ap, 0), 0) AS recall
  FROM counts),
metrics AS (
  SELECT {keys}, {_digits('accuracy', digits)}, {_digits('precision', digits)},
         {_digits('recall', digits)}, {_digits(_F1, digits, 'f1')}
  FROM parts)"""


def _classes(keys: str) -> str:
    on = " AND ".join(f"l.{k.strip()} = p.{k.strip()}" for k in keys.split(","))
    group = ", ".join(f"l.{k.strip()}" for k in keys.split(","))
    return f"""labels_seen AS (
  SELECT {keys}, actual AS label FROM predictions UNION SELECT {keys}, predicted FROM predictions),
cells AS (
  SELECT {keys}, actual, predicted, count(*) AS n FROM predictions GROUP BY {keys}, actual, predicted),
class_counts AS (
  SELECT {group}, l.label,
         sum(CASE WHEN p.actual = l.label THEN n ELSE 0 END) AS ap,
         sum(CASE WHEN p.predicted = l.label THEN n ELSE 0 END) AS pp,
         sum(CASE WHEN p.predicted = l.label AND p.actual = l.label THEN n ELSE 0 END) AS tp
  FROM labels_seen l JOIN cells p ON {on} GROUP BY {group}, l.label),
ratios AS (
  SELECT {keys}, label, coalesce(CAST(tp AS DOUBLE) / nullif(pp, 0), 0) AS precision,
         coalesce(CAST(tp AS DOUBLE) / nullif(ap, 0), 0) AS recall,
         CAST(ap AS DOUBLE) AS support, CAST(tp AS DOUBLE) AS tp
  FROM class_counts),
classes AS (SELECT *, {_F1} AS f1 FROM ratios)"""


def _average(digits: int | None) -> str:
    means = [_digits("sum(tp) / sum(support)", digits, "accuracy")]
    for c in ("precision", "recall", "f1"):
        means.append(_digits(f"sum({c} * support) / sum(support)", digits, c))
    return ", ".join(means)


def _vector_text(row: str = "") -> str:
    """One step of a sequence as text, NULL-free rows assumed."""
    parts = [f"CAST(CAST({row}{c} AS DECIMAL(38,6)) AS VARCHAR)" for c in _FEATURES]
    return " || ',' || ".join(parts)


def _sequences(length: int) -> str:
    frame = f"PARTITION BY symbol ORDER BY date ROWS BETWEEN {length} PRECEDING AND 1 PRECEDING"
    return f"""WITH {_PLACED},
steps AS (SELECT symbol, date, target, place, {_vector_text()} AS step FROM placed),
joined AS (
  SELECT symbol, date, target, place, string_agg(step, ';') OVER ({frame}) AS sequence FROM steps)
SELECT symbol, date, target, sequence FROM joined WHERE place > {length}"""


def _scaled(
    fit: str = "", over: str = "(PARTITION BY symbol)", rounded: tuple = ("sma5", "sma10")
) -> str:
    w = over

    def one(c: str) -> str:
        value = f"CASE WHEN {fit} THEN {c} END" if fit else c
        low, high = f"min({value}) OVER {w}", f"max({value}) OVER {w}"
        part = f"CASE WHEN {low} = {high} THEN 0.0 ELSE ({c} - {low}) / ({high} - {low}) END"
        return f"round({part}, 6) AS {c}" if c in rounded else f"{part} AS {c}"

    return ", ".join(one(c) for c in _FEATURES)


# Features before rounding, for what is computed from them.
_RAW_FEAT = _FEAT.replace("round(avg(", "(avg(").replace("ROW), 6)", "ROW))")

ORACLE: dict[str, str] = {
    "event_bars": f"WITH {_EVENT} SELECT * FROM event_bars",
    "supplier_bars": f"WITH {_SUPPLIER} SELECT * FROM supplier_bars",
    "bar_features": f"WITH {_FEAT} SELECT * FROM feat",
    "event_features": f"""WITH {_EVENT}
SELECT symbol, date, open, high, low, close, CAST(volume AS DOUBLE) AS volume,
{_derived('close', 'date')} FROM event_bars""",
    "tick_features": f"WITH {_TICKS} SELECT symbol, seq, price, {_derived('price', 'ts, seq')} FROM ticks",
    "hot_key_features": f"""WITH {_TYPED}
SELECT symbol, seq, price, {_derived('price', 'ts, seq')} FROM ticks""",
    "hot_key_fill": f"""WITH {_TYPED}, f AS (SELECT symbol, seq, ts,
  last_value(CASE WHEN seq % 7 >= 3 THEN price END IGNORE NULLS) OVER (
    PARTITION BY symbol ORDER BY ts, seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price FROM ticks)
SELECT symbol, seq, coalesce(price, first_value(price IGNORE NULLS) OVER (
    PARTITION BY symbol ORDER BY ts, seq
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS price FROM f""",
    "hot_key_split": f"""WITH {_TYPED} SELECT symbol, seq,
  row_number() OVER (PARTITION BY symbol ORDER BY ts, seq)
    <= floor(count(*) OVER (PARTITION BY symbol) * CAST(0.9 AS DOUBLE)) AS is_train FROM ticks""",
    "hot_key_scaled": f"""WITH {_TYPED} SELECT symbol, seq,
  (price - min(price) OVER (PARTITION BY symbol)) / (max(price) OVER (PARTITION BY symbol)
    - min(price) OVER (PARTITION BY symbol)) AS price FROM ticks""",
    "hot_key_sequences": f"""WITH {_TYPED},
steps AS (SELECT symbol, seq,
  row_number() OVER (PARTITION BY symbol ORDER BY ts, seq) AS place,
  string_agg(CAST(CAST(price AS DECIMAL(38,6)) AS VARCHAR), ';') OVER (
    PARTITION BY symbol ORDER BY ts, seq ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS sequence
  FROM ticks)
SELECT symbol, seq, sequence FROM steps WHERE place > 5""",
    "sma": f"WITH {_FEAT} SELECT symbol, date, sma5, sma10 FROM feat",
    "returns": f"WITH {_FEAT} SELECT symbol, date, ret1, ret5 FROM feat",
    "target": f"WITH {_FEAT} SELECT symbol, date, target FROM feat",
    "target_open_tail": f"WITH {_PLACED} SELECT symbol, date, target FROM placed WHERE place < n",
    "scaler_params": f"WITH {_FEAT} "
    + " UNION ALL ".join(
        f"SELECT symbol, '{c}' AS \"column\", min({c}) AS min, max({c}) AS max FROM feat GROUP BY symbol"
        for c in _FEATURES
    ),
    "minmax_scaled": f"WITH {_RAW_FEAT} SELECT symbol, date, {_scaled()} FROM feat",
    "minmax_stored": f"WITH {_RAW_FEAT} SELECT symbol, date, {_scaled()} FROM feat",
    "prepared_table": f"""WITH {_RAW_FEAT.replace('feat AS', '''holes AS (
  SELECT * REPLACE (CASE WHEN day(date) % 5 <> 0 THEN close END AS close) FROM supplier_bars),
forward AS (
  SELECT * REPLACE (last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close),
    first_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS start FROM holes),
filled AS (SELECT * EXCLUDE (start) REPLACE (coalesce(close, start) AS close) FROM forward),
feat AS''').replace('target FROM supplier_bars', 'target FROM filled')},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date)
         <= floor(count(*) OVER (PARTITION BY symbol) * CAST(0.9 AS DOUBLE)) AS is_train FROM feat),
scaled AS (SELECT symbol, date, target, is_train, {_scaled('is_train')} FROM placed)
SELECT * FROM scaled WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _FEATURES)}""",
    "ffill": """SELECT user_id AS symbol, event_id AS seq,
  last_value(CASE WHEN event_id % 7 >= 3 THEN value END IGNORE NULLS) OVER (
    PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price FROM events""",
    "ffill_bfill": """WITH f AS (SELECT user_id AS symbol, event_id AS seq, ts,
  last_value(CASE WHEN event_id % 7 >= 3 THEN value END IGNORE NULLS) OVER (
    PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price FROM events)
SELECT symbol, seq, coalesce(price, first_value(price IGNORE NULLS) OVER (
    PARTITION BY symbol ORDER BY ts, seq
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS price FROM f""",
    "date_coerce": """WITH dirty AS (
  SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'not a date'
    WHEN event_id % 11 = 0 THEN strftime(ts, '%d-%m-%Y') ELSE strftime(ts, '%Y-%m-%d') END AS text
  FROM events),
coerced AS (
  SELECT event_id, CAST(coalesce(try_strptime(text, '%Y-%m-%d'), try_strptime(text, '%d-%m-%Y'))
    AS DATE) AS date FROM dirty)
SELECT event_id, date FROM coerced WHERE date IS NOT NULL""",
    "drop_any_null": f"""WITH {_GAPPED} SELECT * FROM gapped
WHERE close IS NOT NULL AND sma5 IS NOT NULL AND ret5 IS NOT NULL AND day(date) % 7 <> 0""",
    "nan_to_null": """SELECT event_id AS seq,
  CASE WHEN event_id % 7 <> 0 THEN value END AS price FROM events""",
    "null_defaults": f"""WITH {_GAPPED} SELECT * REPLACE (coalesce(sma5, 0) AS sma5,
  coalesce(ret5, 0) AS ret5) FROM gapped""",
    "drop_columns": f"WITH {_FEAT} SELECT symbol, {', '.join(_FEATURES)} FROM feat",
    "feature_vector": f"WITH {_FEAT} SELECT symbol, date, {_vector_text()} AS features FROM feat",
    "chrono_split": f"""WITH {_PLACED} SELECT symbol, date,
  place <= floor(n * CAST(0.9 AS DOUBLE)) AS is_train FROM placed""",
    "chrono_split_ticks": f"""WITH {_TICKS} SELECT symbol, seq,
  row_number() OVER (PARTITION BY symbol ORDER BY ts, seq)
    <= floor(count(*) OVER (PARTITION BY symbol) * CAST(0.9 AS DOUBLE)) AS is_train FROM ticks""",
    "split_counts": f"""WITH {_PLACED} SELECT symbol, count(*) AS n_rows,
  CAST(sum(CAST(place <= floor(n * CAST(0.9 AS DOUBLE)) AS INTEGER)) AS BIGINT) AS n_train,
  CAST(sum(CAST(place > floor(n * CAST(0.9 AS DOUBLE)) AS INTEGER)) AS BIGINT) AS n_test
FROM placed GROUP BY symbol""",
    "sequences_5": _sequences(5),
    "sequences_10": _sequences(10),
    "sequence_split": f"""WITH {_PLACED} SELECT symbol, date, target,
  place - 5 <= floor((n - 5) * CAST(0.9 AS DOUBLE)) AS is_train FROM placed WHERE place > 5""",
    "rule_scores": f"WITH {_LONG} SELECT * FROM predictions",
    "multi_model_join": f"WITH {_WIDE} SELECT * FROM wide",
    "multi_model_rules": f"WITH {_WIDE} SELECT * FROM wide",
    "correct_flags": f"""WITH {_WIDE} SELECT symbol, date, lr_pred = target AS lr_correct,
  rf_pred = target AS rf_correct, gbt_pred = target AS gbt_correct FROM wide""",
    "match_label": f"""WITH {_LONG} SELECT *,
  CASE WHEN actual = predicted THEN '✔ Correct' ELSE '❌ Incorrect' END AS match FROM predictions""",
    "metrics_binary": f"WITH {_LONG}, {_binary('symbol, model', None)} SELECT * FROM metrics",
    "metrics_weighted": f"""WITH {_LONG}, {_classes('symbol, model')}
SELECT symbol, model, {_average(None)} FROM classes GROUP BY symbol, model""",
    "classification_report": f"""WITH {_LONG}, {_classes('symbol, model')}
SELECT symbol, model, CAST(label AS VARCHAR) AS label, precision, recall, f1,
  CAST(support AS BIGINT) AS support FROM classes
UNION ALL
SELECT symbol, model, 'accuracy', NULL, NULL, sum(tp) / sum(support),
  CAST(sum(support) AS BIGINT) FROM classes GROUP BY symbol, model
UNION ALL
SELECT symbol, model, 'macro avg', avg(precision), avg(recall), avg(f1),
  CAST(sum(support) AS BIGINT) FROM classes GROUP BY symbol, model
UNION ALL
SELECT symbol, model, 'weighted avg', sum(precision * support) / sum(support),
  sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
  CAST(sum(support) AS BIGINT) FROM classes GROUP BY symbol, model""",
    "model_comparison": f"""WITH {_LONG}, {_binary('model', 4)}
SELECT {_TITLE}, accuracy, precision, recall, f1 FROM metrics""",
    "model_comparison_weighted": f"""WITH {_LONG}, {_classes('model')}
SELECT {_TITLE}, {_average(4)} FROM classes GROUP BY model""",
    "last_n_results": f"""WITH {_PLACED} SELECT symbol, strftime(date, '%d-%m-%Y') AS date,
  target AS actual, CAST(close > sma5 AS INTEGER) AS predicted,
  CASE WHEN target = CAST(close > sma5 AS INTEGER) THEN '✔ Correct' ELSE '❌ Incorrect' END AS match
FROM placed WHERE place > floor(n * CAST(0.9 AS DOUBLE)) AND place > n - 10""",
    "threshold": """SELECT event_id AS seq, CAST(value / (value + 10) > 0.5 AS INTEGER) AS label
FROM events""",
    "latency_ms": """SELECT event_id AS seq, CAST(floor((epoch_us(ts) + event_id * 37000) / 1000.0)
  - floor(epoch_us(ts) / 1000.0) AS BIGINT) AS latency_ms FROM events""",
    "sentinel": f"""WITH {_GAPPED} SELECT symbol, date,
  CASE WHEN close IS NULL OR sma5 IS NULL OR ret5 IS NULL THEN -1
       ELSE CAST(ret1 > 0 AS INTEGER) END AS prediction FROM gapped""",
    "prediction_json": f"""WITH {_WIDE} SELECT symbol, CAST(date AS VARCHAR) AS date,
  lr_pred AS lr_prediction, rf_pred AS rf_prediction, gbt_pred AS xgb_prediction,
  CAST(NULL AS INTEGER) AS lstm_prediction FROM wide""",
    "csv_roundtrip": f"WITH {_FEAT} SELECT * FROM feat",
    "read_dispatch": f"""WITH {_SUPPLIER}
SELECT symbol AS supplier, * EXCLUDE (symbol) FROM supplier_bars,
  (VALUES ('csv'), ('json'), ('parquet')) AS f(format)""",
    "union_symbols": """SELECT event_type AS symbol, CAST(ts AS DATE) AS date,
  max(value) AS close, count(*) AS volume FROM events
WHERE event_type IS NOT NULL GROUP BY 1, 2""",
    "publish_json": f"""WITH {_FEAT}
SELECT * EXCLUDE (symbol) REPLACE (CAST(date AS VARCHAR) AS date) FROM feat""",
    "publish_typed": f"""WITH {_SUPPLIER} SELECT CAST(date AS VARCHAR) AS date, {_PRICES},
  CAST(0 AS DOUBLE) AS sma5, CAST(0 AS DOUBLE) AS sma10, CAST(0 AS DOUBLE) AS ret1,
  CAST(0 AS DOUBLE) AS ret5 FROM supplier_bars""",
    "topic_snapshot": f"""WITH {_FEAT} SELECT CAST(date AS VARCHAR) AS date,
  count(*) AS n_messages, round(sum(volume), 2) AS volume, CAST(sum(target) AS BIGINT) AS n_up
FROM feat GROUP BY 1""",
    "parse_messages": f"""WITH {_FEAT} SELECT symbol, date AS day,
  CASE WHEN NOT {_BROKEN} THEN CAST(date AS VARCHAR) END AS date,
  {', '.join(f'CASE WHEN NOT {_BROKEN} THEN {c} END AS {c}' for c in [*_FEATURES, 'target'])}
FROM feat""",
    "dead_letter": f"""WITH {_FEAT} SELECT symbol, date AS day,
  CASE WHEN {_BROKEN} THEN 'dead letter' ELSE 'scored' END AS route FROM feat""",
    "stream_ingest": f"WITH {_FEAT} SELECT * FROM feat",
    "stream_parse": f"""WITH {_FEAT} SELECT
  CASE WHEN NOT {_BROKEN} THEN CAST(date AS VARCHAR) END AS date,
  {', '.join(f'CASE WHEN NOT {_BROKEN} THEN {c} END AS {c}' for c in [*_FEATURES, 'target'])}
FROM feat""",
    "stream_restart": f"WITH {_FEAT} SELECT * FROM feat",
    "paced_replay": f"WITH {_FEAT} SELECT * FROM feat",
    "stream_replay_batches": f"""WITH {_FEAT},
dealt AS (SELECT symbol, date, (row_number() OVER (ORDER BY date, symbol) - 1) // 10000 AS batch_id
  FROM feat)
SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS n_rows, min(date) AS first_day,
  max(date) AS last_day, CAST(sum(symbol) AS BIGINT) AS symbols,
  CAST(sum(CAST(date_diff('day', DATE '1970-01-01', date) AS BIGINT) * symbol) AS BIGINT)
    AS days_and_symbols
FROM dealt GROUP BY batch_id""",
    "stream_score": f"""WITH {_WIDE} SELECT CAST(date AS VARCHAR) AS date, lr_pred, rf_pred,
  gbt_pred, target, TRUE AS timed, lr_pred = target AS lr_correct, rf_pred = target AS rf_correct,
  gbt_pred = target AS gbt_correct FROM wide WHERE NOT {_BROKEN}""",
    "stream_prediction_json": f"""WITH {_WIDE} SELECT CAST(date AS VARCHAR) AS date,
  lr_pred AS lr_prediction, rf_pred AS rf_prediction, gbt_pred AS xgb_prediction,
  CAST(NULL AS INTEGER) AS lstm_prediction FROM wide WHERE NOT {_BROKEN}""",
    "stream_sequence_score": f"""WITH {_PLACED}
SELECT symbol, date, place >= 5 AS answered, TRUE AS same FROM placed""",
    "stream_dead_letters": f"""WITH {_FEAT} SELECT count(*) AS n_dead, CAST(0 AS BIGINT) AS n_readable
FROM feat WHERE {_BROKEN}""",
    "stream_metrics": f"""WITH {_LONG} SELECT model, count(*) AS n_rows,
  CAST(sum(CAST(actual = predicted AS INTEGER)) AS BIGINT) AS n_correct,
  round(avg(CAST(actual = predicted AS INTEGER)), 6) AS accuracy
FROM predictions WHERE NOT {_BROKEN} GROUP BY model""",
    "stream_sequences": f"""WITH {_PLACED},
steps AS (SELECT symbol, date, place, {_vector_text()} AS step FROM placed)
SELECT symbol, date, CASE WHEN place >= 5 THEN string_agg(step, ';') OVER (
  PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) END AS sequence
FROM steps""",
    "stream_bar_features": f"""WITH {_FEAT}
SELECT * FROM feat QUALIFY lead(date) OVER (PARTITION BY symbol ORDER BY date) IS NOT NULL""",
    "stream_running_metrics": f"""WITH {_LONG} SELECT model, count(*) AS n_rows,
  CAST(sum(CAST(actual = predicted AS INTEGER)) AS BIGINT) AS n_correct,
  round(avg(CAST(actual = predicted AS INTEGER)), 6) AS accuracy, TRUE AS near
FROM predictions GROUP BY model""",
    "stream_hot_sequences": """WITH steps AS (
  SELECT event_type AS symbol, event_id AS seq, CAST(CAST(value AS DECIMAL(38,6)) AS VARCHAR) AS step
  FROM events)
SELECT symbol, seq, CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY seq) >= 3
  THEN string_agg(step, ';') OVER (
    PARTITION BY symbol ORDER BY seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS sequence
FROM steps""",
    "stream_score_fitted": f"""WITH {_PLACED}{_TEST}SELECT symbol, date, target, TRUE AS same FROM test""",
    "stream_score_map": f"WITH {_PLACED}{_TEST}SELECT symbol, date, TRUE AS same FROM test",
    "model_roundtrip": f"WITH {_PLACED}{_TEST}SELECT symbol, date, TRUE AS same FROM test",
    "multi_model_chain": f"WITH {_PLACED}{_TEST}SELECT symbol, date, TRUE AS same FROM test",
    "train_planted": f"""WITH {_PLACED}{_TEST}SELECT model, count(*) AS n_rows,
  CAST(sum(CAST(ret1 > 0 AS INTEGER)) AS BIGINT) AS n_up, TRUE AS classes, TRUE AS learned
FROM test, (VALUES ('lr'), ('rf'), ('gbt')) AS m(model) GROUP BY model""",
    "train_recurrent": f"""WITH {_FEAT},
windows AS (
  SELECT lag(close, 1) OVER w > lag(close, 5) OVER w AS up,
         row_number() OVER w - 5 AS place, count(*) OVER (PARTITION BY symbol) - 5 AS n
  FROM feat WINDOW w AS (PARTITION BY symbol ORDER BY date))
SELECT 'lstm' AS model, count(*) AS n_rows, CAST(sum(CAST(up AS INTEGER)) AS BIGINT) AS n_up,
  TRUE AS classes, TRUE AS learned
FROM windows WHERE place > 0 AND place > floor(n * CAST(0.9 AS DOUBLE))""",
    "train_boosted": f"""WITH {_PLACED}{_TEST}SELECT 'xgb' AS model, count(*) AS n_rows,
  CAST(sum(CAST(ret1 > 0 AS INTEGER)) AS BIGINT) AS n_up, TRUE AS classes, TRUE AS learned
FROM test""",
    "train_all_symbols": f"""WITH {_PLACED}{_TEST}SELECT model, count(*) AS n_rows,
  CAST(sum(CAST(ret1 > 0 AS INTEGER)) AS BIGINT) AS n_up, TRUE AS classes, TRUE AS learned
FROM test, (VALUES ('lr'), ('rf'), ('xgb')) AS m(model) GROUP BY model""",
    "stream_score_by_symbol": f"""WITH {_PLACED}{_TEST}SELECT model, count(*) AS n_rows,
  CAST(sum(CAST(ret1 > 0 AS INTEGER)) AS BIGINT) AS n_up, TRUE AS classes, TRUE AS learned
FROM test, (VALUES ('lr'), ('rf')) AS m(model) GROUP BY model""",
    "train_lr_optimum": f"""WITH {_PLACED} SELECT symbol, count(*) AS n_rows,
  CAST(sum(target) AS BIGINT) AS n_up, TRUE AS optimal
FROM placed WHERE place <= floor(n * CAST(0.9 AS DOUBLE)) GROUP BY symbol""",
    "batch_predict": f"""WITH {_PLACED}{_TEST}
SELECT symbol, date, target, TRUE AS consistent FROM test""",
    "udf_score": f"""WITH {_PLACED}{_TEST}SELECT symbol, date,
  CASE WHEN day(date) % 5 <> 0 THEN TRUE END AS scored FROM test""",
    "route_by_model": f"""WITH {_FEAT},
requests AS (
  SELECT *, CASE dayofyear(date) % 6 WHEN 0 THEN 'log' WHEN 1 THEN 'rf' WHEN 2 THEN 'xgb'
    WHEN 3 THEN 'lstm' WHEN 4 THEN 'other' END AS model FROM feat)
SELECT symbol, date, model, CASE coalesce(model, 'log') WHEN 'log' THEN CAST(close > sma5 AS INTEGER)
  WHEN 'rf' THEN CAST(ret1 > 0 AS INTEGER) WHEN 'xgb' THEN CAST(ret5 > 0 AS INTEGER)
  WHEN 'lstm' THEN CAST(close > sma10 AS INTEGER) ELSE -1 END AS prediction FROM requests""",
    "random_split": f"""WITH {_FEAT} SELECT symbol, date,
  CAST('0x' || substr(md5('42|' || CAST(symbol AS VARCHAR) || '|' || CAST(date AS VARCHAR)), 1, 8)
       AS BIGINT) < round(0.9 * 4294967296) AS is_train FROM feat""",
    "minmax_stage": f"""WITH {_RAW_FEAT} SELECT symbol, date, {_scaled(over='()', rounded=tuple(_FEATURES))},
  CAST(0.5 AS DOUBLE) AS flat FROM feat""",
}

ORACLE["stream_keyed_sequences"] = ORACLE["stream_sequences"]
