"""SQL that gives each registered query's result on the given tables.

Written against the definitions, not against the Spark code: recurrences are
recursive, ranks are windows, words are unnested and joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from quotewell import fixed_values
from quotewell.plans.parameters import BOOSTS, DAMPENERS, FIRST_SYMBOL, LEXICON, SECOND_SYMBOL

ORACLE_SQL: dict[str, str] = {}


def _sql(select: str, *parts: str, recursive: bool = False) -> str:
    word = "WITH RECURSIVE" if recursive else "WITH"
    return f"{word} {', '.join(parts)} {select}" if parts else select


def _half_up(value: str, digits: int) -> str:
    """Round as Spark does: halves up on the shortest decimal form of the number."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


# --- Ticks ------------------------------------------------------------------

RAW = """
counted AS (SELECT *, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k FROM events),
raw AS (
  SELECT CASE WHEN k NOT BETWEEN 8 AND 13 THEN CAST(user_id AS VARCHAR) END AS symbol,
         CASE WHEN k < 5 THEN NULL WHEN k < 10 THEN -value ELSE value END AS price,
         value * 0.99 AS open, value * 1.02 AS high, value * 0.98 AS low,
         CASE WHEN k BETWEEN 30 AND 32 THEN NULL WHEN k BETWEEN 33 AND 35 THEN 0.0
              ELSE value * (1 + (k - 50) / 1000.0) END AS prev_close,
         CAST(CASE WHEN k BETWEEN 12 AND 15 THEN NULL WHEN k BETWEEN 16 AND 18 THEN -1
              ELSE k * 1000000 END AS BIGINT) AS volume,
         CAST(k AS BIGINT) * 1000000000 AS market_cap,
         CASE WHEN k NOT BETWEEN 18 AND 21 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS timestamp,
         CASE WHEN k NOT BETWEEN 18 AND 21 THEN ts END AS trade_time
  FROM counted)"""

ENRICHED = """
dim AS (SELECT CAST(c_custkey AS VARCHAR) AS symbol, c_mktsegment AS sector FROM customer WHERE c_acctbal >= 0),
enriched AS (
  SELECT raw.*, price - prev_close AS price_change,
         CASE WHEN prev_close > 0 THEN (price - prev_close) / prev_close * 100 END AS price_change_pct,
         coalesce(dim.sector, 'Unknown') AS sector,
         CASE WHEN volume >= 75000000 THEN 'very_high' WHEN volume >= 25000000 THEN 'high'
              WHEN volume >= 10000000 THEN 'medium' ELSE 'low' END AS volume_category,
         CASE WHEN price IS NULL OR price <= 0 THEN 'Invalid price'
              WHEN raw.symbol IS NULL THEN 'Invalid symbol'
              WHEN volume IS NULL OR volume < 0 THEN 'Invalid volume'
              WHEN timestamp IS NULL THEN 'Invalid timestamp' END AS quarantine_reason
  FROM raw LEFT JOIN dim ON raw.symbol = dim.symbol),
silver AS (SELECT * FROM enriched WHERE quarantine_reason IS NULL)"""

TICK = "symbol, price, open, high, low, prev_close, volume, market_cap, timestamp"
CHANGES = "price_change, price_change_pct, sector, volume_category"

ORACLE_SQL["src_price_stream"] = _sql(f"SELECT {TICK}, trade_time FROM raw", RAW)
ORACLE_SQL["sink_ndjson"] = _sql(f"SELECT {TICK} FROM raw", RAW)
ORACLE_SQL["bronze_prices"] = _sql(f"SELECT {TICK}, trade_time FROM raw", RAW)
ORACLE_SQL["silver_enrich"] = _sql(f"SELECT {TICK}, trade_time, {CHANGES} FROM enriched", RAW, ENRICHED)
ORACLE_SQL["silver_valid"] = _sql(f"SELECT {TICK}, trade_time, {CHANGES} FROM silver", RAW, ENRICHED)
ORACLE_SQL["silver_quarantine"] = _sql(
    f"SELECT {TICK}, trade_time, {CHANGES}, quarantine_reason FROM enriched WHERE quarantine_reason IS NOT NULL",
    RAW,
    ENRICHED,
)
ORACLE_SQL["src_json_inferred"] = _sql(f"SELECT {TICK} FROM raw", RAW)
ORACLE_SQL["priced_only"] = _sql(f"SELECT {TICK.removesuffix(', timestamp')} FROM raw WHERE price IS NOT NULL", RAW)
ORACLE_SQL["quarantine_detail"] = _sql(
    f"""SELECT {TICK}, trade_time, {CHANGES}, quarantine_reason, CASE quarantine_reason
      WHEN 'Invalid price' THEN 'price=' || coalesce(CAST(price AS VARCHAR), 'null') WHEN 'Invalid symbol' THEN 'symbol=null'
      WHEN 'Invalid volume' THEN 'volume=' || coalesce(CAST(volume AS VARCHAR), 'null') ELSE 'timestamp=null' END AS quarantine_detail
    FROM enriched WHERE quarantine_reason IS NOT NULL""",
    RAW,
    ENRICHED,
)
QUALITY = "CASE WHEN quarantine_reason IS NULL THEN 'silver' ELSE 'quarantine' END AS quality"
ORACLE_SQL["quality_split"] = _sql(
    f"""SELECT {QUALITY}, quarantine_reason, sector, count(*) AS row_count, CAST(sum(volume) AS BIGINT) AS total_volume
    FROM enriched GROUP BY ALL""",
    RAW,
    ENRICHED,
)
ORACLE_SQL["stream_quality"] = _sql(
    f"SELECT {TICK}, trade_time, {CHANGES}, quarantine_reason, {QUALITY} FROM enriched", RAW, ENRICHED
)
ORACLE_SQL["quality_report"] = _sql(
    """SELECT rule, passed, (SELECT count(*) FROM raw) - passed AS failed FROM (
    SELECT 'valid_price' AS rule, count(*) AS passed FROM raw WHERE price > 0
    UNION ALL SELECT 'valid_symbol', count(*) FROM raw WHERE symbol IS NOT NULL
    UNION ALL SELECT 'valid_volume', count(*) FROM raw WHERE volume >= 0
    UNION ALL SELECT 'valid_timestamp', count(*) FROM raw WHERE timestamp IS NOT NULL)""",
    RAW,
)
for name in ("stream_quality_counts", "price_layers_rules"):
    ORACLE_SQL[name] = ORACLE_SQL["quality_report"]
ORACLE_SQL["volume_bucket"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
  CASE WHEN l_quantity >= 40 THEN 'very_high' WHEN l_quantity >= 25 THEN 'high'
       WHEN l_quantity >= 10 THEN 'medium' ELSE 'low' END AS volume_category FROM lineitem"""

DAILY = """SELECT symbol, CAST(trade_time AS DATE) AS date, sector,
  arg_min(open, trade_time) AS day_open, max(high) AS day_high,
  min(low) AS day_low, arg_max(price, trade_time) AS day_close,
  CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS trade_count,
  round(avg(price_change_pct), 12) AS avg_change_pct
  FROM silver GROUP BY ALL"""
ORACLE_SQL["daily_ohlcv"] = _sql(DAILY, RAW, ENRICHED)
ORACLE_SQL["sink_partitioned"] = _sql(DAILY, RAW, ENRICHED)
CANDLES = """
candles AS (
  SELECT symbol, time_bucket(INTERVAL '1 minute', trade_time) AS candle_start,
         time_bucket(INTERVAL '1 minute', trade_time) + INTERVAL '1 minute' AS candle_end,
         arg_min(open, trade_time) AS open, max(high) AS high, min(low) AS low,
         arg_max(price, trade_time) AS close, CAST(sum(volume) AS BIGINT) AS volume,
         count(*) AS trade_count
  FROM silver GROUP BY ALL)"""
ORACLE_SQL["candles_1m"] = _sql("SELECT * FROM candles", RAW, ENRICHED, CANDLES)
ORACLE_SQL["stream_candles"] = _sql(
    "SELECT * FROM candles WHERE candle_end <= (SELECT max(trade_time) FROM silver) - INTERVAL '2 minutes'",
    RAW,
    ENRICHED,
    CANDLES,
)
ORACLE_SQL["price_layers_daily"] = _sql(DAILY, RAW, ENRICHED)
ORACLE_SQL["price_layers_sectors"] = ORACLE_SQL["sector_daily"] = _sql(
    """SELECT sector, CAST(trade_time AS DATE) AS date, round(avg(price_change_pct), 12) AS avg_change_pct,
    CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS stock_count FROM silver GROUP BY ALL""",
    RAW,
    ENRICHED,
)
ORACLE_SQL["sector_extremes"] = _sql(
    """SELECT sector, round(avg(price_change_pct), 12) AS avg_change_pct,
    CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS stock_count,
    arg_max(symbol, row(price_change_pct, symbol)) FILTER (price_change_pct IS NOT NULL) AS top_gainer,
    arg_min(symbol, row(price_change_pct, symbol)) FILTER (price_change_pct IS NOT NULL) AS top_loser
    FROM silver GROUP BY sector""",
    RAW,
    ENRICHED,
)

# --- Bars -------------------------------------------------------------------


def _bars(symbol: str, sector: str) -> str:
    return f"""
    trades AS (SELECT CAST({symbol} AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date,
                      l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS volume,
                      l_orderkey, l_linenumber, l_partkey FROM lineitem),
    daily AS (
      SELECT symbol, date,
             arg_min(price, row(l_orderkey, l_linenumber, l_partkey, price)) AS day_open,
             max(price) AS day_high, min(price) AS day_low,
             arg_max(price, row(l_orderkey, l_linenumber, l_partkey, price)) AS day_close,
             CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS trade_count
      FROM trades GROUP BY symbol, date),
    bars AS (
      SELECT daily.*, sector,
             coalesce((day_close - lag(day_close) OVER w) / nullif(lag(day_close) OVER w, 0) * 100, 0.0) AS avg_change_pct,
             row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY symbol) AS len,
             day_close - lag(day_close) OVER w AS change
      FROM daily {sector}
      WINDOW w AS (PARTITION BY symbol ORDER BY date))"""


BARS = _bars(
    "l_suppkey",
    """LEFT JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS symbol, r_name AS sector
       FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
       AS regions USING (symbol)""",
)
PART_BARS = _bars("l_partkey", "CROSS JOIN (SELECT 'Unknown' AS sector) AS no_sector")
BAR = """symbol, date, sector, day_open, day_high, day_low, day_close, total_volume, trade_count, avg_change_pct"""



def _trailing(values: str, rows: int) -> str:
    """Sum over the trailing rows, added up in date order."""
    return f"list_sum({values}[pos - {rows - 2}:pos + 1])"


def _mean(values: str, rows: int) -> str:
    return f"CASE WHEN pos >= {rows - 1} THEN {_half_up(f'{_trailing(values, rows)} / {rows}', 4)} END"


AVERAGES = f"""
series AS (
  SELECT symbol, list(day_close ORDER BY date) AS closes, list(day_close * total_volume ORDER BY date) AS traded,
         list(total_volume ORDER BY date) AS volumes FROM bars GROUP BY symbol),
averages AS (
  SELECT symbol, sector, date, day_close, total_volume,
         {_mean('closes', 5)} AS sma_5, {_mean('closes', 20)} AS sma_20, {_mean('closes', 50)} AS sma_50,
         CASE WHEN pos >= 19 THEN {_half_up(f"{_trailing('traded', 20)} / {_trailing('volumes', 20)}", 4)} END AS vwap_20
  FROM bars JOIN series USING (symbol))"""
SPIKES = f"""
preceding AS (
  SELECT symbol, sector, date, total_volume,
         avg(total_volume) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS mean
  FROM bars),
spikes AS (
  SELECT symbol, sector, date, total_volume, CAST(round(mean, 0) AS BIGINT) AS avg_volume_20d,
         {_half_up('total_volume / nullif(mean, 0)', 2)} AS volume_ratio, total_volume / nullif(mean, 0) > 2.0 AS is_spike
  FROM preceding WHERE mean IS NOT NULL)"""
RANKINGS = f"""
ranked AS (
  SELECT symbol, sector, date, avg_change_pct,
         rank() OVER (PARTITION BY sector, date ORDER BY avg_change_pct DESC) AS place,
         count(*) OVER (PARTITION BY sector, date) AS size FROM bars),
rankings AS (
  SELECT symbol, sector, date, avg_change_pct, CAST(place AS INTEGER) AS sector_rank, CAST(size AS INTEGER) AS sector_size,
         {_half_up('(1 - (place - 1) / size) * 100', 1)} AS percentile
  FROM ranked)"""

ORACLE_SQL["daily_bars"] = _sql(f"SELECT {BAR} FROM bars", BARS)
ORACLE_SQL["history_profile"] = _sql(
    "SELECT symbol, count(*) AS days, min(date) AS first_date, max(date) AS last_date FROM bars GROUP BY symbol", BARS
)
ORACLE_SQL["moving_averages"] = _sql("SELECT * FROM averages", BARS, AVERAGES)
ORACLE_SQL["volume_spikes"] = _sql("SELECT * FROM spikes", BARS, SPIKES)
ORACLE_SQL["layout_by_symbol"] = _sql("SELECT * FROM spikes", BARS, SPIKES)
ORACLE_SQL["sector_rankings"] = _sql(
    "SELECT * FROM rankings",
    BARS,
    RANKINGS,
)
ORACLE_SQL["daily_change"] = _sql(
    "SELECT symbol, date, day_close, avg_change_pct FROM bars",
    BARS,
)
ORACLE_SQL["table_profile"] = _sql(
    """SELECT 'stock_prices_silver' AS table_name, (SELECT count(*) FROM silver) AS row_count
    UNION ALL SELECT 'stock_daily_summary', (SELECT count(*) FROM bars)
    UNION ALL SELECT 'moving_averages', (SELECT count(*) FROM averages)
    UNION ALL SELECT 'volume_spikes', (SELECT count(*) FROM spikes)""",
    RAW,
    ENRICHED,
    BARS,
    AVERAGES,
    SPIKES,
)

# --- Indicators -------------------------------------------------------------


def _ema(name: str, source: str, value: str, first: int, period: int) -> str:
    """Recursive EMA over (symbol, pos), seeded with the mean of ``period`` values from ``first``."""
    start, k = first + period - 1, f"(2.0::DOUBLE / {period + 1})"
    return f"""
    {name} AS (
      SELECT symbol, CAST({start} AS BIGINT) AS pos, avg({value}) AS ema FROM {source}
      WHERE pos BETWEEN {first} AND {start} GROUP BY symbol HAVING count(*) = {period}
      UNION ALL
      SELECT p.symbol, s.pos, s.{value} * {k} + p.ema * (1 - {k})
      FROM {name} AS p JOIN {source} AS s ON s.symbol = p.symbol AND s.pos = p.pos + 1)"""


RSI = """
wilder AS (
  SELECT symbol, CAST(14 AS BIGINT) AS pos, avg(greatest(change, 0)) AS gain, avg(greatest(-change, 0)) AS loss
  FROM bars WHERE pos BETWEEN 1 AND 14 GROUP BY symbol HAVING count(*) = 14
  UNION ALL
  SELECT p.symbol, b.pos, (p.gain * 13 + greatest(b.change, 0)) / 14, (p.loss * 13 + greatest(-b.change, 0)) / 14
  FROM wilder AS p JOIN bars AS b ON b.symbol = p.symbol AND b.pos = p.pos + 1),
rsi AS (
  SELECT bars.symbol, CASE WHEN gain = 0 AND loss = 0 THEN 50.0 WHEN loss = 0 THEN 100.0
         ELSE round(100 - 100 / (1 + gain / loss), 4) END AS rsi
  FROM bars LEFT JOIN wilder USING (symbol, pos) WHERE bars.pos = len - 1)"""
MACD = ", ".join(
    [
        _ema("fast", "bars", "day_close", 0, 12),
        _ema("slow", "bars", "day_close", 0, 26),
        "lines AS (SELECT symbol, pos, fast.ema - slow.ema AS line FROM fast JOIN slow USING (symbol, pos))",
        _ema("smooth", "lines", "line", 25, 9),
        """
macd AS (
  SELECT symbol, round(line, 4) AS macd_line, round(coalesce(smooth.ema, line), 4) AS macd_signal,
         round(round(line, 4) - round(coalesce(smooth.ema, line), 4), 4) AS macd_histogram
  FROM bars LEFT JOIN lines USING (symbol, pos) LEFT JOIN smooth USING (symbol, pos) WHERE pos = len - 1)""",
    ]
)
BANDS = f"""
recent AS (
  SELECT symbol, avg(day_close) AS mean, 2.0 * stddev_pop(day_close) AS reach
  FROM bars WHERE pos >= len - 20 AND len >= 20 GROUP BY symbol),
bands AS (
  SELECT symbol, {_half_up('mean + reach', 4)} AS bb_upper, {_half_up('mean', 4)} AS bb_middle, {_half_up('mean - reach', 4)} AS bb_lower
  FROM (SELECT DISTINCT symbol FROM bars) LEFT JOIN recent USING (symbol))"""
SIGNALS = """
indicators AS (
  SELECT symbol, sector, date AS latest_date, day_close AS latest_close, rsi, macd_line, macd_signal, macd_histogram,
         bb_upper, bb_middle, bb_lower
  FROM bars JOIN rsi USING (symbol) JOIN macd USING (symbol) JOIN bands USING (symbol) WHERE pos = len - 1),
votes AS (
  SELECT *, CASE WHEN rsi < 30 THEN 2 WHEN rsi < 45 THEN 1 WHEN rsi > 70 THEN -2 WHEN rsi > 55 THEN -1 ELSE 0 END
         + CASE WHEN macd_histogram > 0 THEN 1 WHEN macd_histogram < 0 THEN -1 ELSE 0 END
         + CASE WHEN bb_upper <= bb_lower THEN 0
                WHEN (latest_close - bb_lower) / (bb_upper - bb_lower) < 0.15 THEN 1
                WHEN (latest_close - bb_lower) / (bb_upper - bb_lower) > 0.85 THEN -1 ELSE 0 END AS score
  FROM indicators),
signals AS (
  SELECT * EXCLUDE (score),
         CASE WHEN rsi IS NULL OR macd_histogram IS NULL OR bb_upper IS NULL OR latest_close IS NULL THEN 'hold'
              WHEN score >= 3 THEN 'strong_buy' WHEN score >= 1 THEN 'buy' WHEN score <= -3 THEN 'strong_sell'
              WHEN score <= -1 THEN 'sell' ELSE 'hold' END AS signal
  FROM votes)"""
ALL_SIGNALS = (RSI, MACD, BANDS, SIGNALS)

ORACLE_SQL["rsi"] = _sql("SELECT symbol, rsi FROM rsi", BARS, RSI, recursive=True)
ORACLE_SQL["ema"] = _sql(
    f"""SELECT symbol, date, day_close, {_half_up('ema', 4)} AS ema_12
    FROM fast JOIN bars USING (symbol, pos)""",
    BARS,
    _ema("fast", "bars", "day_close", 0, 12),
    recursive=True,
)
ORACLE_SQL["macd"] = _sql("SELECT * FROM macd", BARS, MACD, recursive=True)
ORACLE_SQL["bollinger"] = _sql("SELECT * FROM bands", BARS, BANDS)
ORACLE_SQL["classify_signal"] = _sql("SELECT symbol, signal FROM signals", BARS, *ALL_SIGNALS, recursive=True)
ORACLE_SQL["technical_indicators"] = _sql("SELECT * FROM indicators", BARS, *ALL_SIGNALS, recursive=True)
ORACLE_SQL["market_signals"] = _sql("SELECT * FROM signals", BARS, *ALL_SIGNALS, recursive=True)
ORACLE_SQL["stream_signals"] = ORACLE_SQL["market_signals"]
ORACLE_SQL["market_signals_short"] = _sql(
    "SELECT * FROM signals", PART_BARS, *ALL_SIGNALS, recursive=True
)
ORACLE_SQL["signal_distribution"] = _sql(
    "SELECT signal, count(*) AS symbol_count FROM signals GROUP BY signal", BARS, *ALL_SIGNALS, recursive=True
)

# --- Series without a daily bound -------------------------------------------

CANDLE_BARS = """
bars AS (
  SELECT symbol, CAST(NULL AS VARCHAR) AS sector, candle_start AS date, close AS day_close, volume AS total_volume,
         row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY symbol) AS len,
         close - lag(close) OVER w AS change,
         coalesce((close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) * 100, 0.0) AS avg_change_pct
  FROM candles WINDOW w AS (PARTITION BY symbol ORDER BY candle_start))"""
OF_CANDLES = (RAW, ENRICHED, CANDLES, CANDLE_BARS)
ORACLE_SQL["candle_averages"] = _sql("SELECT * EXCLUDE (sector) FROM averages", *OF_CANDLES, AVERAGES)
ORACLE_SQL["candle_spikes"] = _sql("SELECT * EXCLUDE (sector) FROM spikes", *OF_CANDLES, SPIKES)
ORACLE_SQL["candle_change"] = _sql("SELECT symbol, date, day_close, avg_change_pct FROM bars", *OF_CANDLES)
ORACLE_SQL["candle_ema"] = _sql(
    f"""SELECT symbol, date, day_close, {_half_up('ema', 4)} AS ema_12
    FROM fast JOIN bars USING (symbol, pos)""",
    *OF_CANDLES,
    _ema("fast", "bars", "day_close", 0, 12),
    recursive=True,
)
ORACLE_SQL["candle_signals"] = _sql("SELECT * EXCLUDE (sector) FROM signals", *OF_CANDLES, *ALL_SIGNALS, recursive=True)

# --- News -------------------------------------------------------------------

HEADLINE = "split_part(text, chr(10), 1)"
BODY = f"substr(text, length({HEADLINE}) + 2)"
PUBLISHED = "strftime(TIMESTAMP '2024-01-01' + to_minutes(doc_id), '%Y-%m-%dT%H:%M:%SZ')"
MOMENT = "TIMESTAMP '2024-01-01' + to_minutes(doc_id)"
NEWS = f"""
news AS (
  SELECT doc_id, CASE WHEN n_chars NOT BETWEEN 100 AND 199 THEN '<b>' || {HEADLINE} || '</b>' END AS headline,
         '<p>&ldquo;' || {BODY} || '&#8221;&nbsp;</p>' AS summary, source,
         'https://news.example/' || doc_id AS url,
         CASE WHEN lang = 'es' THEN [] ELSE [source, lang] END AS symbols,
         CASE WHEN n_chars < 300 THEN '' WHEN n_chars NOT BETWEEN 300 AND 399 THEN {PUBLISHED} END AS published_at,
         CASE WHEN n_chars > 399 THEN {MOMENT} END AS pub_time
  FROM documents)"""
ORACLE_SQL["src_news_stream"] = _sql(
    "SELECT headline, summary, source, url, published_at, pub_time FROM news", NEWS
)
ORACLE_SQL["bronze_news"] = _sql("SELECT * EXCLUDE (symbols) FROM news", NEWS)
ORACLE_SQL["news_valid"] = _sql(
    """SELECT doc_id, headline, summary, source, url, published_at FROM news
    WHERE headline IS NOT NULL AND published_at IS NOT NULL""",
    NEWS,
)
ARTICLES = f"""
articles AS (
  SELECT {HEADLINE} AS headline, CASE WHEN lang = 'de' THEN '' ELSE {BODY} END AS summary,
         CASE WHEN lang = 'fr' THEN 'Unknown' ELSE source END AS source,
         CASE WHEN lang = 'de' THEN '' ELSE 'https://news.example/' || doc_id END AS url,
         CASE WHEN lang = 'es' THEN '' ELSE {PUBLISHED} END AS published_at, doc_id, source AS symbol
  FROM documents WHERE n_chars NOT BETWEEN 100 AND 249)"""
ORACLE_SQL["news_normalize"] = _sql("SELECT * FROM articles", ARTICLES)
ORACLE_SQL["news_dedupe"] = _sql(
    "SELECT * FROM articles QUALIFY row_number() OVER (PARTITION BY headline ORDER BY symbol, doc_id) = 1", ARTICLES
)
ORACLE_SQL["staging_append"] = _sql("SELECT headline, summary, source, url, [symbol] AS symbols, published_at FROM articles", ARTICLES)
ORACLE_SQL["stream_dedupe"] = _sql("SELECT DISTINCT headline FROM articles", ARTICLES)

# --- Text -------------------------------------------------------------------

SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _clean(text: str) -> str:
    """Entities that occur in the given tables, ampersands last; then tags; then white space."""
    for entity, value in (
        ("&copy;", "chr(169)"),
        ("&middot;", "chr(183)"),
        ("&quot;", "chr(34)"),
        ("&ldquo;", "chr(8220)"),
        ("&#8221;", "chr(8221)"),
        ("&nbsp;", "chr(160)"),
    ):
        text = f"replace({text}, '{entity}', {value})"
    text = f"regexp_replace({text}, '&amp;?', '&', 'g')"
    text = f"regexp_replace({text}, '<[^>]+>', '', 'g')"
    return f"coalesce(trim(regexp_replace({text}, '{SPACE}', ' ', 'g')), '')"


def _boost(text: str, boosts: dict[str, float] = BOOSTS) -> str:
    found = " + ".join(
        f"CASE WHEN contains(lower({text}), '{phrase}') THEN {weight}::DOUBLE ELSE 0 END" for phrase, weight in boosts.items()
    )
    return f"least(greatest({found}, -0.5), 0.5)"


def _dampened(text: str, dampeners: Sequence[str] = DAMPENERS) -> str:
    return "(" + " OR ".join(f"contains(lower({text}), '{phrase}')" for phrase in dampeners) + ")"


def _lexicon_table(lexicon: dict[str, tuple[float, float]]) -> str:
    quoted = ((word.replace("'", "''"), *weights) for word, weights in lexicon.items())
    return "lexicon(word, valence, tone) AS (VALUES {})".format(
        ", ".join(f"('{word}', {valence}::DOUBLE, {tone}::DOUBLE)" for word, valence, tone in quoted)
    )


LEXICON_TABLE = _lexicon_table(LEXICON)


def _stats(name: str, source: str, text: str) -> str:
    """Sums over the lexicon words of each text."""
    return f"""
    {name} AS (
      SELECT doc_id, count(*) AS hits, sum(valence) AS valence, sum(tone) AS tone
      FROM (SELECT doc_id, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}'']+')) AS word FROM {source})
      JOIN lexicon USING (word) GROUP BY doc_id)"""


def _a(stats: str) -> str:
    return f"coalesce({stats}.valence / sqrt({stats}.valence * {stats}.valence + 15), 0)"


def _b(stats: str) -> str:
    return f"coalesce({stats}.tone / {stats}.hits, 0)"


ORACLE_SQL["clean_text"] = f"SELECT page_id, {_clean('html')} AS clean FROM pages"
ORACLE_SQL["keyword_boost"] = f"SELECT doc_id, round({_boost('text')}, 4) AS boost FROM documents"
ORACLE_SQL["dampen"] = f"""SELECT doc_id, round(CASE WHEN {_dampened('text')} THEN n_chars / 1000.0 * 0.3::DOUBLE
  ELSE n_chars / 1000.0 END, 6) AS score FROM documents"""
POLARITY = f"""SELECT documents.doc_id, round({_a('stats')}, 12) AS model_a, round({_b('stats')}, 12) AS model_b
  FROM documents LEFT JOIN stats USING (doc_id)"""
ORACLE_SQL["polarity"] = _sql(POLARITY, LEXICON_TABLE, _stats("stats", "documents", "text"))
ORACLE_SQL["polarity_by_table"] = _sql(
    POLARITY,
    r"""lexicon AS (
    SELECT DISTINCT word, CAST(length(word) % 9 - 4 AS DOUBLE) AS valence, (length(word) % 9 - 4) / 4.0 AS tone
    FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\p{L}'']+')) AS word FROM benchmark) WHERE length(word) > 3)""",
    _stats("stats", "documents", "text"),
)

_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}'']+'), lambda x: x <> '')"
PHRASES = f"""
item_words AS (SELECT {_WORDS} AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT phrase, (length(phrase) % 7 - 3) / 100.0 AS weight FROM (
    SELECT array_to_string(w[i:i + n - 1], ' ') AS phrase
    FROM (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS i FROM item_words, (SELECT unnest([2, 3]) AS n)))),
spaced AS (SELECT doc_id, n_chars, ' ' || array_to_string({_WORDS}, ' ') || ' ' AS t FROM documents),
hits AS (SELECT doc_id, phrase, weight FROM spaced, phrases WHERE contains(t, ' ' || phrase || ' '))"""
ORACLE_SQL["boost_by_table"] = _sql(
    """SELECT doc_id, round(least(greatest(coalesce(sum(weight), 0), -0.5), 0.5), 6) AS boost, count(phrase) AS phrases
    FROM documents LEFT JOIN hits USING (doc_id) GROUP BY doc_id""",
    PHRASES,
)
ORACLE_SQL["dampen_by_table"] = _sql(
    """SELECT doc_id, round(n_chars / 1000.0 * CASE WHEN doc_id IN (SELECT doc_id FROM hits WHERE length(phrase) > 20)
    THEN 0.3 ELSE 1 END, 6) AS score FROM documents""",
    PHRASES,
)

CLEANED = f"""
cleaned AS (SELECT *, trim(head || '. ' || body, '. ') AS joined FROM (
  SELECT *, {_clean('headline')} AS head, {_clean('summary')} AS body FROM news))"""


def _scored(
    weighted: bool,
    lexicon: dict[str, tuple[float, float]] = LEXICON,
    boosts: dict[str, float] = BOOSTS,
    dampeners: Sequence[str] = DAMPENERS,
) -> tuple[str, ...]:
    if weighted:
        stats = (_stats("head_stats", "cleaned", "head"), _stats("body_stats", "cleaned", "body"))
        tables = "LEFT JOIN head_stats USING (doc_id) LEFT JOIN body_stats USING (doc_id)"
        a, b = (
            f"""CASE WHEN body = '' THEN {model('head_stats')} WHEN head = '' THEN {model('body_stats')}
            ELSE {model('head_stats')} * 0.6::DOUBLE + {model('body_stats')} * 0.4::DOUBLE END"""
            for model in (_a, _b)
        )
    else:
        stats = (_stats("stats", "cleaned", "joined"),)
        tables, a, b = "LEFT JOIN stats USING (doc_id)", _a("stats"), _b("stats")
    return (
        NEWS,
        _lexicon_table(lexicon),
        CLEANED,
        *stats,
        f"modelled AS (SELECT cleaned.*, {a} AS a, {b} AS b FROM cleaned {tables})",
        f"""blended AS (
        SELECT *, CASE WHEN joined = '' THEN 0 ELSE least(greatest(
          (a * 0.6::DOUBLE + b * 0.4::DOUBLE + {_boost('joined', boosts)})
          * CASE WHEN {_dampened('joined', dampeners)} THEN 0.3::DOUBLE ELSE 1 END, -1), 1) END AS score FROM modelled)""",
        """scored AS (
        SELECT doc_id, headline, summary, source, url, symbols, published_at,
          round(score, 4) AS sentiment_score,
          CASE WHEN score > 0.05 THEN 'positive' WHEN score < -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
          CASE WHEN joined = '' THEN 1 ELSE round(least(greatest(1 - abs(a - b), 0), 1), 4) END AS confidence
        FROM blended)""",
    )


SCORE = "doc_id, sentiment_score, sentiment_label, confidence"
VALID_SCORED = "valid_scored AS (SELECT * FROM scored WHERE headline IS NOT NULL AND published_at IS NOT NULL)"
GOOD_NEWS = (*_scored(True), VALID_SCORED)
ORACLE_SQL["score_article"] = _sql(f"SELECT {SCORE} FROM scored", *_scored(False))
ORACLE_SQL["score_article_shipped"] = _sql(
    f"SELECT {SCORE} FROM scored", *_scored(False, fixed_values.LEXICON, fixed_values.BOOST_PHRASES, fixed_values.DAMPENING_PHRASES)
)
ORACLE_SQL["score_article_weighted"] = _sql(f"SELECT {SCORE} FROM scored", *_scored(True))
for name in ("news_silver", "stream_news"):
    ORACLE_SQL[name] = _sql("SELECT * EXCLUDE (symbols, summary) FROM valid_scored", *GOOD_NEWS)

SENTIMENT = """
sentiment AS (
  SELECT symbol, round(avg(sentiment_score), 12) AS avg_sentiment, count(*) AS article_count,
         max(sentiment_score) AS max_sentiment, min(sentiment_score) AS min_sentiment,
         arg_max(headline, row(sentiment_score, published_at, doc_id)) AS most_positive,
         arg_min(headline, row(sentiment_score, published_at, doc_id)) AS most_negative
  FROM (SELECT *, unnest(symbols) AS symbol FROM valid_scored) GROUP BY symbol)"""


def _mood(threshold: float) -> str:
    return f"""
mood AS (
  SELECT CASE WHEN avg_score > {threshold} THEN 'bullish' WHEN avg_score < -{threshold} THEN 'bearish' ELSE 'neutral' END AS mood, *
  FROM (SELECT round(coalesce(avg(sentiment_score), 0), 12) AS avg_score, count(*) AS article_count,
               count(*) FILTER (sentiment_label = 'positive') AS positive_count,
               count(*) FILTER (sentiment_label = 'negative') AS negative_count,
               count(*) FILTER (sentiment_label = 'neutral') AS neutral_count FROM valid_scored))"""


MOOD = _mood(0.02)
ORACLE_SQL["symbol_sentiment"] = _sql(
    "SELECT * FROM sentiment", *GOOD_NEWS, SENTIMENT
)
ORACLE_SQL["market_mood"] = _sql("SELECT * FROM mood", *GOOD_NEWS, MOOD)
ORACLE_SQL["market_mood_default"] = _sql("SELECT * FROM mood", *GOOD_NEWS, _mood(0.2))

# --- Serving ----------------------------------------------------------------

ORACLE_SQL["sentiment_lookup"] = _sql(
    f"""SELECT symbol, {_half_up('avg_sentiment', 3)} AS avg_sentiment,
    CASE WHEN avg_sentiment > 0.05 THEN 'bullish' WHEN avg_sentiment < -0.05 THEN 'bearish' ELSE 'neutral' END AS label,
    article_count, most_positive, most_negative FROM sentiment""",
    *GOOD_NEWS,
    SENTIMENT,
)
ORACLE_SQL["mood_lookup"] = _sql(f"SELECT * REPLACE ({_half_up('avg_score', 3)} AS avg_score) FROM mood", *GOOD_NEWS, MOOD)

LATEST = "latest AS (SELECT * FROM bars WHERE date = (SELECT max(date) FROM bars))"
ORACLE_SQL["latest_slice"] = _sql(f"SELECT {BAR} FROM latest", BARS, LATEST)
ORACLE_SQL["latest_quote"] = _sql(
    f"""SELECT symbol, date, {_half_up('day_close', 2)} AS price, {_half_up('day_open', 2)} AS open, {_half_up('day_high', 2)} AS high,
    {_half_up('day_low', 2)} AS low, total_volume AS volume, {_half_up('avg_change_pct', 2)} AS change_pct, sector
    FROM bars WHERE pos = len - 1""",
    BARS,
)
ORACLE_SQL["sector_board"] = _sql(
    f"""SELECT sector, date, count(*) OVER (PARTITION BY sector) AS stock_count,
    first_value(symbol) OVER (PARTITION BY sector ORDER BY sector_rank, symbol) AS top_gainer,
    first_value(symbol) OVER (PARTITION BY sector ORDER BY sector_rank DESC, symbol DESC) AS top_loser,
    symbol, {_half_up('day_close', 2)} AS price, {_half_up('avg_change_pct', 2)} AS change_pct, sector_rank AS rank, percentile
    FROM (SELECT l.*, r.sector_rank, r.percentile FROM latest AS l LEFT JOIN rankings AS r USING (symbol, date))""",
    BARS,
    RANKINGS,
    LATEST,
)
ORACLE_SQL["technical_snapshot"] = _sql(
    f"""SELECT symbol, sector, latest_date AS date, {_half_up('latest_close', 2)} AS price, {_half_up('rsi', 2)} AS rsi,
    macd_line, macd_signal, macd_histogram, {_half_up('bb_upper', 2)} AS bollinger_upper,
    {_half_up('bb_middle', 2)} AS bollinger_middle, {_half_up('bb_lower', 2)} AS bollinger_lower, signal FROM signals""",
    BARS,
    *ALL_SIGNALS,
    recursive=True,
)
ORACLE_SQL["compare_symbols"] = _sql(
    f"""SELECT symbol, s.sector, {_half_up('latest_close', 2)} AS price, {_half_up('rsi', 2)} AS rsi, macd_histogram, signal,
    {_half_up('sma_5', 2)} AS sma_5, {_half_up('sma_20', 2)} AS sma_20, {_half_up('vwap_20', 2)} AS vwap_20
    FROM signals AS s JOIN averages AS a USING (symbol)
    WHERE symbol IN ('{FIRST_SYMBOL.strip()}', '{SECOND_SYMBOL.strip()}') AND a.date = s.latest_date""",
    BARS,
    *ALL_SIGNALS,
    AVERAGES,
    recursive=True,
)


def _movers(best_first: bool) -> str:
    """Top movers as (kind, position, symbol, value); losers by their rank from the end or the start."""
    loser_order = "DESC" if best_first else "ASC"
    loser_tie = "ASC" if best_first else "DESC"
    return f"""
    places AS (
      SELECT symbol, avg_change_pct, total_volume,
             row_number() OVER (ORDER BY avg_change_pct DESC, symbol) AS best,
             row_number() OVER (ORDER BY avg_change_pct, symbol DESC) AS worst,
             row_number() OVER (ORDER BY total_volume DESC, symbol) AS active FROM latest),
    movers AS (
      SELECT 'top_gainer' AS kind, CAST(best AS INTEGER) AS position, symbol, {_half_up('avg_change_pct', 2)} AS value
      FROM places WHERE best <= 3
      UNION ALL
      SELECT 'top_loser', CAST(row_number() OVER (ORDER BY avg_change_pct {loser_order}, symbol {loser_tie}) AS INTEGER),
             symbol, {_half_up('avg_change_pct', 2)} FROM places WHERE worst <= 3
      UNION ALL
      SELECT 'most_active', CAST(active AS INTEGER), symbol, CAST(total_volume AS DOUBLE) FROM places WHERE active <= 3)"""


ORACLE_SQL["top_movers"] = _sql("SELECT kind, position, symbol, value FROM movers", BARS, LATEST, _movers(False))
SIGNAL_COUNTS = "SELECT 'signal', NULL, signal, CAST(count(*) AS DOUBLE) FROM signals GROUP BY signal"
ORACLE_SQL["market_summary"] = _sql(
    f"""SELECT 'overview' AS section, CAST(NULL AS INTEGER) AS position, CAST(max(date) AS VARCHAR) AS label,
    CAST(count(*) AS DOUBLE) AS value FROM latest
    UNION ALL SELECT kind, position, symbol, value FROM movers
    UNION ALL {SIGNAL_COUNTS}
    UNION ALL SELECT 'volume_spike', NULL, symbol, volume_ratio FROM spikes
    WHERE is_spike AND date = (SELECT max(date) FROM bars)""",
    BARS,
    LATEST,
    _movers(False),
    SPIKES,
    *ALL_SIGNALS,
    recursive=True,
)
ORACLE_SQL["dashboard_metrics"] = _sql(
    f"""SELECT 'total' AS section, CAST(NULL AS INTEGER) AS position, 'symbols' AS label,
    CAST(count(*) AS DOUBLE) AS value FROM latest
    UNION ALL SELECT kind, position, symbol, value FROM movers WHERE kind <> 'most_active'
    UNION ALL {SIGNAL_COUNTS}""",
    BARS,
    LATEST,
    _movers(True),
    *ALL_SIGNALS,
    recursive=True,
)


def _fixed(value: str, digits: int) -> str:
    """The number with that many decimals, halves up on the decimal digits shown."""
    exact = f"abs(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)))"
    return f"CAST(CAST(round({exact}, {digits}) AS DECIMAL(38, {digits})) AS VARCHAR)"


def _signed(value: str, digits: int, plus: str = "") -> str:
    return f"CASE WHEN {value} < 0 THEN '-' ELSE '{plus}' END || {_fixed(value, digits)}"


ORACLE_SQL["signal_board"] = _sql(
    f"""SELECT symbol, sector, '$' || {_fixed('latest_close', 2)} AS price, coalesce({_fixed('rsi', 1)}, '—') AS rsi,
    coalesce({_signed('macd_histogram', 4)}, '—') AS macd_histogram, upper(signal) AS signal,
    CASE signal WHEN 'buy' THEN 'green' WHEN 'sell' THEN 'red' ELSE 'yellow' END AS color FROM signals""",
    BARS,
    *ALL_SIGNALS,
    recursive=True,
)
ORACLE_SQL["performance_board"] = _sql(
    f"""SELECT symbol, sector, avg_change_pct AS change_pct,
    CASE WHEN avg_change_pct >= 0 THEN 'green' ELSE 'red' END AS color,
    {_signed('avg_change_pct', 2, '+')} || '%' AS label FROM latest""",
    BARS,
    LATEST,
)
ORACLE_SQL["query_log_stats"] = """
SELECT count(*) AS total_queries, CAST(sum(length(q.text) % 5) AS BIGINT) AS total_tool_calls,
       round(avg(length(a.text) / 100.0), 2) AS avg_latency, round(avg(length(q.text) % 5), 1) AS avg_tools
FROM conversations AS q JOIN conversations AS a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
WHERE q.role = 'user' AND a.role = 'assistant'"""

# --- Whole layers -----------------------------------------------------------


def _counts(**tables: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM ({rows})) AS row_count" for name, rows in tables.items()
    )


CLOSED = "SELECT * FROM candles WHERE candle_end <= (SELECT max(trade_time) FROM silver) - INTERVAL '2 minutes'"
DAYS = "days AS (SELECT DISTINCT symbol, CAST(trade_time AS DATE) AS date, sector FROM silver)"
ORACLE_SQL["price_layers"] = _sql(
    _counts(
        stock_prices_bronze="SELECT * FROM raw",
        stock_prices_silver="SELECT * FROM silver",
        stock_prices_quarantine="SELECT * FROM enriched WHERE quarantine_reason IS NOT NULL",
        stock_candles_1m=CLOSED,
        stock_daily_summary="SELECT * FROM days",
        sector_performance="SELECT DISTINCT sector, date FROM days",
    ),
    RAW,
    ENRICHED,
    CANDLES,
    DAYS,
)
ORACLE_SQL["news_layers"] = _sql(
    _counts(
        stock_news_bronze="SELECT * FROM news",
        news_sentiment_silver="SELECT * FROM good",
        symbol_sentiment_agg="SELECT DISTINCT unnest(symbols) FROM good",
        market_mood="SELECT 1",
    ),
    NEWS,
    "good AS (SELECT * FROM news WHERE headline IS NOT NULL AND published_at IS NOT NULL)",
)
ORACLE_SQL["news_layers_sentiment"] = _sql(
    "SELECT * FROM sentiment", *GOOD_NEWS, SENTIMENT.replace("published_at, doc_id", "published_at, headline")
)
ORACLE_SQL["news_layers_mood"] = _sql("SELECT * FROM mood", *GOOD_NEWS, _mood(0.2))
ORACLE_SQL["analytics_layers"] = _sql(
    _counts(
        technical_indicators="SELECT DISTINCT symbol FROM days",
        market_signals="SELECT DISTINCT symbol FROM days",
        moving_averages="SELECT * FROM days",
        sector_rankings="SELECT * FROM days",
        volume_spikes="SELECT * FROM days QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date) > 1",
    ),
    RAW,
    ENRICHED,
    DAYS,
)
