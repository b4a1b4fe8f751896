"""SQL equivalents of the queries in ``__spark_entry__.py``, for DuckDB on the same tables.

The expressions at the top derive inputs (catalogues, statements, name lines) from the
tables; both engines read them alike, so query and equivalent start from the same rows.
"""

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

CATALOGUE = (
    "concat('T', l_orderkey) AS table_name",
    "l_linenumber AS column_id",
    "concat('C', l_partkey) AS column_name",
    """coalesce(nullif(split_part(
    'VARCHAR2|NVARCHAR2|CHAR|NCHAR|UROWID|DATE|TIMESTAMP(6)|TIMESTAMP(3)|CLOB|LONG RAW|FLOAT|XMLTYPE',
    '|', CAST(l_suppkey % 20 + 1 AS int)), ''), 'NUMBER') AS data_type""",
    "CAST((l_partkey * 7) % 12001 AS int) AS char_length",
    "CAST(CASE WHEN l_linenumber IN (3, 5) THEN NULL ELSE l_suppkey % 39 END AS int) AS data_precision",
    """CAST(CASE WHEN l_returnflag = 'A' THEN NULL WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity - 3 END AS int)
    AS data_scale""",
    "l_linenumber > 1 AS nullable",
    "CAST(NULL AS varchar(10)) AS comments",
    """nullif(split_part(CASE WHEN l_linenumber = 7
    THEN '''a b''|SYS_GUID()|user|sysdate|( (SYSDATE) )|(7)|-1|1.5|NULL|''''|0|SEQ.NEXTVAL'
    ELSE '''a b''|SYS_GUID()|user|sysdate|( (SYSDATE) )|(7)|-1|1.5|NULL|''''|0|42' END,
    '|', CAST(l_partkey % 14 + 1 AS int)), '') AS data_default""",
    """CAST(CASE WHEN l_linestatus = 'O' AND l_linenumber = 2 THEN NULL ELSE l_linenumber + 1 END AS int)
    AS avg_col_len""",
)
NAME_LINES = ("CASE WHEN o_orderstatus = 'P' THEN '   ' "
              "ELSE concat('  ', lower(o_orderpriority), ' , ', o_orderstatus) END")
# Columns of the given tables: w whole numbers of 64 bits, i of 32 bits, d doubles, t times, s texts, v vectors.
_KINDS = {
    "region": "r_regionkey:i r_name:s", "nation": "n_nationkey:i n_name:s n_regionkey:i",
    "customer": "c_custkey:w c_name:s c_nationkey:i c_acctbal:d c_mktsegment:s",
    "supplier": "s_suppkey:w s_name:s s_nationkey:i s_acctbal:d",
    "part": "p_partkey:w p_name:s p_brand:s p_type:s p_size:i p_retailprice:d",
    "orders": "o_orderkey:w o_custkey:w o_orderstatus:s o_totalprice:d o_orderdate:t o_orderpriority:s",
    "lineitem": "l_orderkey:w l_partkey:w l_suppkey:w l_linenumber:i l_quantity:d l_extendedprice:d l_discount:d l_tax:d "
                "l_returnflag:s l_linestatus:s l_shipdate:t",
    "events": "event_id:w ts:t user_id:w event_type:s value:d props:s", "documents": "doc_id:w text:s lang:s source:s n_chars:w",
    "embeddings": "vec_id:w embedding:v label:i", "pages": "page_id:w url:s html:s", "benchmark": "item_id:w text:s",
    "labels": "doc_id:w quality:i toxic:i", "conversations": "conv_id:w turn:w role:s text:s",
}
COLUMNS = {table: [tuple(c.split(":")) for c in kinds.split()] for table, kinds in _KINDS.items()}
_SOURCE_TYPES = {"w": "NUMBER", "i": "NUMBER", "d": "BINARY_DOUBLE", "t": "TIMESTAMP(6)", "s": "VARCHAR2", "v": "ARRAY<FLOAT>"}
INDEX_FACTS = (
    "CASE WHEN o_orderpriority = '2-HIGH' THEN 'UNIQUE' ELSE 'NONUNIQUE' END AS uniqueness",
    "CASE WHEN o_orderstatus = 'P' THEN 'FUNCTION-BASED NORMAL' WHEN o_orderpriority = '5-LOW' THEN 'BITMAP' "
    "ELSE 'NORMAL' END AS index_type",
)
CONSTRAINT_TYPE = "CASE o_orderstatus WHEN 'F' THEN 'P' WHEN 'O' THEN 'R' ELSE 'U' END AS constraint_type"
TRIGGERS = (
    "concat('T', o_custkey) AS table_name",
    "CASE WHEN o_orderstatus = 'P' THEN 'AFTER EACH ROW' ELSE 'BEFORE EACH ROW' END AS trigger_type",
    "concat('begin select ', CASE WHEN o_orderpriority = '5-LOW' THEN 'max(id)' ELSE 's.nextval' END, "
    "CASE WHEN o_orderpriority = '2-HIGH' THEN ' into:new.c' ELSE ' INTO :NEW.C' END, o_custkey % 7, "
    "CASE WHEN o_orderpriority = '3-MEDIUM' THEN ' from sys.dual ;' WHEN o_orderpriority = '1-URGENT' "
    "THEN ' where 1 = 1;' ELSE ' from dual;' END, ' end;') AS trigger_body",
)
VIEW_TEXT = ("concat('select nvl(a,0), unistr(''', chr(92), '0030''), unistr(''', chr(92), '0033'') -- ', text, "
             "' nvl(b,1) --')")
TRIGGER_TEXT = "concat('into:new.id from sys.dual ;', text, ' sys.dual')"
DEFINITION_TEXT = (
    "concat('CREATE VIEW \"U\".\"V', doc_id, '\" AS SELECT UPPER(N), ou.x, u.y FROM u.t -- ', text, "
    "CASE WHEN lang = 'fr' THEN ' PCTFREE 10 pctfree' WHEN lang = 'de' THEN ' pctfree 20' ELSE '' END)"
)

_LINEITEM = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
             "l_returnflag, l_linestatus, l_shipdate")
_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)
_CHANGED = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" + (" WHERE o_orderstatus <> 'F'" if t == "orders" else "")
    for t in TABLES if t != "region")
_COMPARE = f"""
SELECT upper(s.table_name) AS source_table_name, s.row_count AS source_rows, 'TABLE' AS db_type,
  coalesce(upper(t.table_name), 'TABLE NOT EXIST') AS target_table_name, coalesce(t.row_count, -1) AS target_rows,
  CASE WHEN s.row_count = t.row_count THEN 'Y' ELSE 'N' END AS is_success
FROM ({_COUNTS}) s LEFT JOIN ({_CHANGED}) t USING (table_name) WHERE s.table_name <> 'benchmark'"""

_STATS = f"""
SELECT *, coalesce(data_precision, -1) AS p, coalesce(avg_col_len, -1) AS a,
  CASE WHEN data_scale IS NULL THEN -1 WHEN data_scale > 30 THEN least(coalesce(data_precision, 30), 30) - 1
       ELSE data_scale END AS s
FROM (SELECT {", ".join(CATALOGUE)} FROM lineitem)"""
_WHOLE = "data_type = 'NUMBER' AND ((p > 0 AND s = 0) OR (p = -1 AND s IN (-1, 0)))"
_TEXT = "data_type IN ('VARCHAR2', 'NVARCHAR2', 'CHAR', 'NCHAR', 'UROWID')"
_BARE_PATTERN = r"'^[\s(]*(''(?:[^'']|'''')*''|[^()'']+(?:\(\))?)[\s)]*$'"
_BARE = f"""trim(CASE WHEN regexp_matches(data_default, {_BARE_PATTERN})
  THEN regexp_extract(data_default, {_BARE_PATTERN}, 1) ELSE data_default END)"""
_NAMED = rf"upper(regexp_replace({_BARE}, '\(\)$', ''))"
_DEFAULT = rf"""CASE
  WHEN data_default IS NULL OR {_NAMED} IN ('NULL', '') THEN NULL
  WHEN data_type IN ('DATE', 'TIMESTAMP(6)', 'TIMESTAMP(3)')
    THEN CASE WHEN {_NAMED} = 'SYSDATE' THEN 'current_timestamp()' END
  WHEN {_TEXT} THEN CASE WHEN {_NAMED} NOT IN ('SYSDATE', 'SYS_GUID', 'USER') THEN {_BARE} END
  WHEN data_type IN ('NUMBER', 'FLOAT')
    THEN nullif(regexp_extract({_BARE}, '(?:^|[^\w.])(-?(?:\d+(?:\.\d+)?|\.\d+))(?:$|[^\w.])', 1), '')
  WHEN data_type IN ('CLOB', 'LONG RAW') THEN NULL
  ELSE {_BARE} END"""
_COMPAT_DEFAULT = rf"""CASE
  WHEN data_type IN ('VARCHAR2', 'NVARCHAR2') AND char_length >= 10000 THEN 'null'
  WHEN {_TEXT} THEN CASE WHEN replace(replace(replace(upper(data_default), ' ', ''), '(', ''), ')', '')
      IN ('SYSDATE', 'SYS_GUID', 'USER') THEN ''
    ELSE replace(replace(replace(upper(data_default), ' ', ''), '(', ''), ')', '') END
  WHEN data_type IN ('DATE', 'TIMESTAMP(6)')
    THEN CASE WHEN data_default IN ('sysdate', '( (SYSDATE) )') THEN 'current_timestamp()' ELSE '' END
  WHEN {_WHOLE} THEN CASE WHEN data_default IS NULL OR upper(data_default) LIKE 'NULL%' THEN data_default
    WHEN data_default = '''''' THEN '' ELSE regexp_extract(data_default, '\b\d+\b', 0) END
  WHEN data_type IN ('CLOB', 'LONG RAW') THEN ''
  ELSE data_default END"""


def _rule(cases: list[tuple[str, str, str, str]]) -> str:
    """``(condition, rule, target type, Spark type)`` in order, as three CASE columns."""
    columns = []
    for at, name in ((2, "target_type"), (3, "spark_type"), (1, "rule")):
        columns.append("CASE " + " ".join(f"WHEN {case[0]} THEN {case[at]}" for case in cases) + f" END AS {name}")
    return ", ".join(columns)


_PLAIN_TEXT = [
    ("data_type IN ('VARCHAR2', 'NVARCHAR2', 'UROWID')", "'varchar'", "concat('VARCHAR(', char_length, ')')", "'string'"),
    ("data_type IN ('CHAR', 'NCHAR')", "'char'", "concat('CHAR(', char_length, ')')", "'string'"),
]
_LARGE = [
    ("data_type = 'CLOB'", "'longtext'", "'LONGTEXT'", "'string'"),
    ("data_type = 'LONG RAW'", "'longblob'", "'LONGBLOB'", "'binary'"),
]
_UNMAPPED = [("true", "'unmapped'", "concat(data_type, '(', char_length, ')')", "NULL")]
_SAFE = _PLAIN_TEXT + [
    ("data_type IN ('DATE', 'TIMESTAMP(6)', 'TIMESTAMP(3)')", "'datetime'", "'DATETIME'", "'timestamp_ntz'"),
    ("data_type = 'NUMBER' AND p > 0 AND s > 0", "'decimal'", "concat('DECIMAL(', greatest(p, s), ',', s, ')')",
     "concat('decimal(', greatest(p, s), ',', s, ')')"),
    (f"{_WHOLE} AND a BETWEEN 0 AND 5", "'int'", "'INT'", "'int'"),
    (_WHOLE, "'bigint'", "'BIGINT'", "'bigint'"),
    ("data_type = 'NUMBER'", "'number_fallback'", "concat('DECIMAL(38,', greatest(s, 0), ')')",
     "concat('decimal(38,', greatest(s, 0), ')')"),
] + _LARGE + [("data_type = 'FLOAT'", "'double'", "'DOUBLE'", "'double'")] + _UNMAPPED
_COMPAT = [
    ("data_type IN ('VARCHAR2', 'NVARCHAR2') AND char_length >= 10000", "'tinytext'", "'TINYTEXT'", "'string'"),
] + _PLAIN_TEXT + [
    ("data_type IN ('DATE', 'TIMESTAMP(6)')", "'datetime'", "'DATETIME'", "'timestamp_ntz'"),
    ("data_type = 'NUMBER' AND p > 0 AND s > 0", "'decimal'", "concat('DECIMAL(', p, ',', s, ')')",
     "concat('decimal(', p, ',', s, ')')"),
    (f"{_WHOLE} AND a >= 6", "'bigint'", "'BIGINT'", "'bigint'"),
    (f"{_WHOLE} AND a < 6", "'int'", "'INT'", "'int'"),
    ("data_type = 'NUMBER'", "'dropped'", "NULL", "NULL"),
] + _LARGE + _UNMAPPED
_LENGTH = f"CASE WHEN {_TEXT} THEN char_length END AS max_length"
_LOST = rf"""bool_or({_WHOLE} AND data_default IS NOT NULL AND upper(data_default) NOT LIKE 'NULL%'
  AND data_default <> '''''' AND NOT regexp_matches(data_default, '\b\d+\b')) OVER (PARTITION BY table_name)"""


def _digest(column: str, table: str = "documents") -> str:
    return f"SELECT doc_id, length(t) AS chars, md5(t) AS digest FROM (SELECT doc_id, {column} AS t FROM {table})"


def _lexed(column: str) -> str:
    """Tokens of a text rewritten one by one; a code token ends before each letter u, dash and slash."""
    tokens = r"""unistr\('\\003[013]'\)|'[^']*(?:'|\z)|"[^"]*(?:"|\z)|--[^\n]*|/\*(?s:.*?)(?:\*/|\z)|[^'"/u-]+|[-/u]"""
    rewritten = r"""CASE WHEN regexp_full_match(x, 'unistr\(''\\003[013]''\)') THEN substr(x, 13, 1)
        WHEN starts_with(x, '--') THEN regexp_replace(x, '^--([^ \t])', '-- \1')
        WHEN x[1] IN (chr(39), '"') OR starts_with(x, '/*') THEN x ELSE replace(x, 'nvl(', 'ifnull(') END"""
    pattern = tokens.replace("'", "''")
    return f"array_to_string(list_transform(regexp_extract_all({column}, '{pattern}'), lambda x: {rewritten}), '')"


def _described(tables: list[str] = TABLES) -> str:
    """Name, place, source type, precision and scale of every column."""
    digits = {"w": "19, 0", "i": "10, 0"}
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {n} AS column_id, '{c}' AS column_name, '{_SOURCE_TYPES[kind]}' AS data_type, "
        + ", ".join(f"{x}::INT AS {name}" for x, name in zip(digits.get(kind, "NULL, NULL").split(", "), ("data_precision", "data_scale")))
        for t in tables for n, (c, kind) in enumerate(COLUMNS[t], 1))


def _measured() -> str:
    """Longest text and mean stored length."""
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {f'max(length({c}))' if kind == 's' else 'max(NULL)'}::INT AS char_length, "
        f"{'max(NULL)' if kind == 'v' else f'ceil(avg(strlen({c}::VARCHAR)))'}::INT AS avg_col_len FROM {t}"
        for t in TABLES for c, kind in COLUMNS[t])


def _measured_types() -> str:
    largest = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, max(abs({c}))::DOUBLE AS largest FROM {t}"
        for t in TABLES for c, kind in COLUMNS[t] if kind in "wi")
    return f"""
        SELECT table_name, column_id, column_name, char_length AS max_length,
          CASE data_type WHEN 'VARCHAR2' THEN 'varchar' WHEN 'BINARY_DOUBLE' THEN 'double' WHEN 'TIMESTAMP(6)' THEN 'datetime'
            WHEN 'ARRAY<FLOAT>' THEN 'unmapped' ELSE CASE WHEN avg_col_len < 6 AND largest <= 2147483647 THEN 'int' ELSE 'bigint' END
            END AS rule,
          CASE data_type WHEN 'VARCHAR2' THEN concat('VARCHAR(', char_length, ')') WHEN 'ARRAY<FLOAT>' THEN data_type
            ELSE upper(rule) END AS target_type
        FROM ({_described()}) JOIN ({_measured()}) USING (table_name, column_name)
        LEFT JOIN ({largest}) USING (table_name, column_name)"""


def _widths() -> str:
    longest = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, coalesce(max(length({c})), 0)::INT AS max_length FROM {t}"
        for t in TABLES for c, kind in COLUMNS[t] if kind == "s")
    return (f"SELECT *, CASE WHEN max_length = 0 THEN 100 ELSE round_even(max_length * 1.5, 0) END::INT AS width "
            f"FROM ({longest})")


def _numbers() -> str:
    def exact(c: str) -> str:
        return f"CASE WHEN try_cast({c}::VARCHAR AS DECIMAL(38, 10))::DOUBLE = {c} THEN try_cast({c}::VARCHAR AS DECIMAL(38, 10)) END"

    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, round(avg(strlen({c}::VARCHAR)), 4) AS avg_length, "
        + (f"min({exact(c)})::DOUBLE AS min_value, max({exact(c)})::DOUBLE AS max_value, "
           f"coalesce(max(length(rtrim(split_part(({exact(c)})::VARCHAR, '.', 2), '0'))), 0)::INT AS max_scale, "
           f"count({c}) - count({exact(c)}) AS inexact" if kind == "d" else
           f"min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value, 0 AS max_scale, 0::BIGINT AS inexact") + f" FROM {t}"
        for t in TABLES for c, kind in COLUMNS[t] if kind in "wid")


_REASON = """nullif(concat_ws(';',
  CASE WHEN event_id IS NULL THEN 'event_id:null' END, CASE WHEN length(event_type) > 6 THEN 'event_type:length' END,
  CASE WHEN value IS NOT NULL AND try_cast(value AS DECIMAL(4, 2)) IS NULL THEN 'value:type' END), '')"""
_LOGS = """
SELECT 'customer' AS table_name, (SELECT count(*) FROM customer) AS source_table_rows,
  (SELECT count(*) FROM customer) AS target_table_rows
UNION ALL SELECT 'orders', (SELECT count(*) FROM orders),
  (SELECT count(*) FROM orders WHERE try_cast(o_totalprice AS DECIMAL(7, 2)) IS NOT NULL)
UNION ALL SELECT 'part', (SELECT count(*) FROM part), (SELECT count(*) FROM part WHERE length(p_name) <= 9)"""
_TRIGGER_ROWS = f"""
SELECT *, replace(replace(replace(replace(upper(trigger_body), 'INTO:', 'INTO :'), 'SYS.DUAL ', 'DUAL'),
  'SYS.DUAL', 'DUAL'), chr(10), '') AS body FROM (SELECT {", ".join(TRIGGERS)} FROM orders)"""
_FK_LISTS = """
SELECT concat('K', l_orderkey) AS k, string_agg(concat('C', l_partkey), ',' ORDER BY l_linenumber,
  concat('C', l_partkey)) AS cols FROM lineitem GROUP BY 1"""

ORACLES = {
    "scan_counts": _COUNTS,
    "range_scan_text": "SELECT lang, count(*) AS row_count, count(*) AS range_count FROM documents GROUP BY 1",
    "range_scan": "SELECT o_orderstatus, count(*) AS row_count FROM orders GROUP BY 1",
    "name_list": f"""SELECT name, count(*) AS lines FROM (SELECT upper(trim(split_part({NAME_LINES}, ',', 1))) AS name
        FROM orders) WHERE name <> '' GROUP BY 1""",
    "restrict_to_list": "SELECT doc_id, source FROM documents WHERE upper(trim(source)) IN ('SRC3', 'SRC7', 'NOSUCH')",
    "load_append": "SELECT count(*) * 2 AS row_count, (sum(c_custkey) * 2)::BIGINT AS key_sum FROM customer",
    "load_truncate": """SELECT o_orderstatus, count(*) AS row_count, sum(o_orderkey)::BIGINT AS key_sum, 0::BIGINT AS prices
        FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""",
    "read_types": """SELECT l_orderkey::VARCHAR AS l_orderkey, l_linenumber, l_quantity::INT AS l_quantity,
        l_extendedprice::DECIMAL(12, 1)::DOUBLE AS l_extendedprice FROM lineitem""",
    "save_log": f"SELECT source_table_name, is_success, 2::BIGINT AS kept FROM ({_COMPARE})",
    "column_catalogue": _described(),
    "measured_catalogue": _measured(),
    "map_notes": f"""SELECT table_name, column_id, column_name, nullable, concat('line "', l_linestatus, '"') AS comments
        FROM (SELECT {", ".join(c for c in CATALOGUE if not c.endswith("AS comments"))}, l_linestatus FROM lineitem)""",
    "map_types": f"""SELECT table_name, column_id, column_name, {_rule(_SAFE)}, {_LENGTH},
        {_DEFAULT} AS target_default FROM ({_STATS})""",
    "map_types_measured": _measured_types(),
    "map_types_compat": f"""
        SELECT table_name, column_id, column_name, CASE WHEN NOT lost THEN target_type END AS target_type,
          CASE WHEN NOT lost THEN spark_type END AS spark_type, CASE WHEN NOT lost THEN max_length END AS max_length,
          CASE WHEN NOT lost THEN target_default END AS target_default,
          CASE WHEN lost THEN 'table_lost' ELSE rule END AS rule
        FROM (SELECT table_name, column_id, column_name, {_rule(_COMPAT)}, {_LENGTH},
          {_COMPAT_DEFAULT} AS target_default, {_LOST} AS lost FROM ({_STATS}))""",
    "clean_defaults": f"""SELECT data_type, data_default, {_DEFAULT} AS target_default, count(*) AS row_count
        FROM ({_STATS}) GROUP BY ALL""",
    "clean_defaults_compat": f"""SELECT data_type, data_default, {_COMPAT_DEFAULT} AS target_default,
        count(*) AS row_count FROM ({_STATS}) GROUP BY ALL""",
    "fit_row_width": f"""
        WITH c AS (SELECT * FROM ({_STATS})),
        w AS (SELECT concat('T', l_orderkey) AS table_name, concat('C', l_partkey) AS column_name,
          max(l_quantity)::INT AS width FROM lineitem GROUP BY 1, 2),
        big AS (SELECT table_name FROM c GROUP BY 1 HAVING sum(char_length) > 65535)
        SELECT table_name, column_id, column_name, CASE WHEN narrowed THEN width ELSE char_length END AS fitted_length,
          narrowed
        FROM (SELECT c.*, w.width, c.table_name IN (SELECT table_name FROM big)
            AND data_type IN ('VARCHAR2', 'NVARCHAR2') AS narrowed FROM c JOIN w USING (table_name, column_name))""",
    "fit_row_width_least": f"""
        WITH c AS (SELECT * FROM ({_STATS})),
        w AS (SELECT concat('T', l_orderkey) AS table_name, concat('C', l_partkey) AS column_name,
          max(l_quantity)::INT AS width FROM lineitem GROUP BY 1, 2),
        s AS (SELECT c.*, w.width, sum(coalesce(char_length, 0)) OVER (PARTITION BY table_name) AS row_width,
            CASE WHEN data_type IN ('VARCHAR2', 'NVARCHAR2') THEN greatest(coalesce(char_length, 0) - width, 0) ELSE 0 END AS saved
          FROM c JOIN w USING (table_name, column_name)),
        r AS (SELECT *, sum(saved) OVER (PARTITION BY table_name ORDER BY saved DESC, column_id, column_name
            ROWS UNBOUNDED PRECEDING) - saved AS before, sum(saved) OVER (PARTITION BY table_name) AS every FROM s)
        SELECT table_name, column_id, column_name, CASE WHEN narrowed THEN width ELSE char_length END AS fitted_length, narrowed,
          row_width <= 9000 OR row_width - every <= 9000 AS fits
        FROM (SELECT *, row_width > 9000 AND saved > 0 AND row_width - before > 9000 AS narrowed FROM r)""",
    "text_widths": _widths(),
    "number_widths": _numbers(),
    "profile_merged": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
          {f'min({c})' if number else 'NULL'}::DOUBLE AS min_number, {f'max({c})' if number else 'NULL'}::DOUBLE AS max_number,
          {'NULL' if number else f'min({c})'}::VARCHAR AS min_text, {'NULL' if number else f'max({c})'}::VARCHAR AS max_text,
          {'NULL' if number else f'max(length({c}))'}::INT AS max_length FROM documents"""
        for c, number in (("doc_id", True), ("text", False), ("lang", False), ("n_chars", True))),
    "conform_rows": f"""SELECT event_id, strftime(date_trunc('second', ts + INTERVAL 500 MILLISECONDS),
          '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, try_cast(value AS DECIMAL(4, 2))::DOUBLE AS value, props
        FROM events WHERE {_REASON} IS NULL""",
    "reject_rows": f"""SELECT event_id, ts::VARCHAR AS ts, user_id, event_type, value, props, {_REASON} AS reject_reason FROM events
        WHERE {_REASON} IS NOT NULL""",
    "conform_fractions": """SELECT l_orderkey, l_linenumber, l_extendedprice AS price, nullif(concat_ws(';',
          CASE WHEN l_extendedprice <> floor(l_extendedprice) THEN 'l_extendedprice:scale' END,
          CASE WHEN l_discount <> floor(l_discount) THEN 'l_discount:scale' END), '') AS reject_reason FROM lineitem""",
    "page_numbers": """SELECT o_orderkey, CASE WHEN page > 0 THEN (page - 1) * 1000 + 1 ELSE 0 END AS start_row,
          CASE WHEN page > 0 THEN page * 1000 ELSE 999 END AS end_row
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % 50 END AS page FROM orders)""",
    "page_counts_compat": f"""SELECT table_name, ((row_count + 999) // 1000)::BIGINT AS pages,
          round_even((row_count + 999) / 1000, 0)::BIGINT AS pages_compat FROM ({_COUNTS})""",
    "zoned_elapsed": """SELECT user_id, (epoch(date_trunc('second', max(ts) + INTERVAL 90 SECONDS)) - epoch(date_trunc('second', min(ts))))::BIGINT
          AS run_time FROM events GROUP BY 1""",
    "common_columns": """SELECT concat('T', l_orderkey) AS table_name, l_linenumber AS column_id,
          concat('C', l_partkey) AS column_name FROM lineitem
        WHERE (l_orderkey, l_partkey) IN (SELECT (l_orderkey, l_partkey) FROM lineitem WHERE l_linestatus = 'O')""",
    "load_common_columns": "SELECT o_orderkey, o_custkey, o_orderpriority, NULL::VARCHAR AS o_comment FROM orders",
    "page_plan": f"""SELECT table_name, page_no, (page_no - 1) * 1000 + 1 AS start_row, page_no * 1000 AS end_row
        FROM (SELECT table_name, unnest(generate_series(1, ((row_count + 999) // 1000)::BIGINT)) AS page_no
          FROM ({_COUNTS}))""",
    "page_rows": """SELECT (rn - 1) // 1000 + 1 AS page_no, count(*) AS row_count, min(o_orderkey) AS first_key,
          max(o_orderkey) AS last_key
        FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) GROUP BY 1""",
    "page_rows_copies": """SELECT (rn - 1) // 1000 + 1 AS page_no, l_returnflag, l_linestatus, count(*) AS row_count,
          min(rn) AS first_row, max(rn) AS last_row
        FROM (SELECT l_returnflag, l_linestatus, row_number() OVER (ORDER BY l_returnflag, l_linestatus) AS rn
          FROM lineitem) GROUP BY 1, 2, 3""",
    "page_slice": f"""SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM (SELECT *,
          row_number() OVER (ORDER BY {_LINEITEM}) AS row_no FROM lineitem) WHERE row_no BETWEEN 5001 AND 6000""",
    "transfer_log": """SELECT 'orders' AS table_name, (rn - 1) // 1000 + 1 AS page_no, any_value(n) AS source_table_rows,
          count(*) AS target_table_rows, 'TABLE' AS type
        FROM (SELECT row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders) GROUP BY 2""",
    "transfer_status": f"""SELECT *, CASE WHEN source_table_rows = target_table_rows THEN 'Y' ELSE 'N' END AS is_success
        FROM ({_LOGS})""",
    "transfer_report": f"""SELECT row_number() OVER (ORDER BY run_detail, table_name) AS id, *
        FROM (SELECT *, CASE WHEN source_table_rows <> target_table_rows THEN 'TABLE INSERT FAIL' ELSE 'SUCCESS' END
          AS run_detail FROM ({_LOGS}) UNION ALL SELECT 'absent', 0, 0, 'TABLE NOT EXIST')""",
    "copy_log": f"""SELECT 'events' AS table_name, count(*) AS source_table_rows,
          count(*) FILTER ({_REASON} IS NULL) AS target_table_rows, count(*) FILTER ({_REASON} IS NULL) AS written_rows,
          count(*) FILTER ({_REASON} IS NOT NULL) AS rejected_rows FROM events""",
    "task_elapsed": """SELECT user_id, (epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts))))::BIGINT
          AS run_time FROM events GROUP BY 1""",
    "run_full": """
        WITH bad AS (SELECT
          (SELECT count(*) > 0 FROM (SELECT 1 FROM customer GROUP BY c_custkey HAVING count(*) > 1))::INT
          + (SELECT count(*) > 0 FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))::INT
          + (SELECT count(*) > count(o_custkey) FROM orders)::INT
          + (SELECT count(*) > 0 FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber
              HAVING count(*) > 1))::INT AS keys,
          (SELECT count(*) > 0 FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))::INT
          + (SELECT count(*) > 0 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))::INT AS refs)
        , tables AS (SELECT 'customer' AS t, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
          UNION ALL SELECT 'lineitem', count(*) FROM lineitem)
        SELECT 'report' AS part, concat_ws('|', t, n, n, 'SUCCESS') AS line FROM tables UNION ALL SELECT 'report', 'absent|0|0|TABLE NOT EXIST'
        UNION ALL SELECT 'compare', concat_ws('|', upper(t), n, 'TABLE', upper(t), n, 'Y') FROM tables
        UNION ALL SELECT 'compare', 'ABSENT|-|TABLE|TABLE NOT EXIST|-1|N' UNION ALL SELECT 'summary', 'TABLE|4|3|1'
        UNION ALL SELECT 'summary', concat_ws('|', 'CONSTRAINT INDEX', 4, 4 - keys, keys) FROM bad
        UNION ALL SELECT 'summary', concat_ws('|', 'FOREIGN KEY', 2, 2 - refs, refs) FROM bad""",
    "run_failing": """SELECT 'TABLE' AS kind, 'customer' AS name, count(*) AS target_table_rows, 'SUCCESS' AS outcome FROM customer
        UNION ALL SELECT 'TABLE', 'orders', count(*) FILTER (o_totalprice = floor(o_totalprice)), 'TABLE INSERT FAIL' FROM orders
        UNION ALL SELECT 'TABLE', 'absent', 0, 'TABLE NOT EXIST'
        UNION ALL SELECT 'CONSTRAINT INDEX', 'customer primary key', NULL, 'failed'
        UNION ALL SELECT 'CONSTRAINT INDEX', 'orders primary key', NULL, 'end'""",
    "run_decimals": """WITH o AS (SELECT count(*) AS n, count(*) FILTER (o_totalprice::DECIMAL(12, 1)::DOUBLE = o_totalprice) AS fit FROM orders)
        SELECT 'ORDERS' AS name, n AS source_rows, fit AS target_rows, CASE WHEN n = fit THEN 'Y' ELSE 'N' END AS outcome FROM o
        UNION ALL SELECT 'o_totalprice:scale', n - fit, 0, 'rejected' FROM o WHERE n > fit""",
    "transfer_resumed": """SELECT (row_no - 1) // 1000 + 1 AS page_no, count(*) AS source_table_rows, count(*) AS target_table_rows,
          sum(o_orderkey)::BIGINT AS key_sum, min(o_orderkey) AS first_key
        FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_no FROM orders) GROUP BY 1""",
    "assign_ids_again": """WITH keyed AS (SELECT o_orderkey, o_custkey AS c, CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority END AS p FROM orders),
        first AS (SELECT c, p, row_number() OVER (ORDER BY c, p NULLS FIRST) AS id FROM (SELECT DISTINCT c, p FROM keyed WHERE o_orderkey % 3 = 0)),
        later AS (SELECT c, p, (SELECT max(id) FROM first) + row_number() OVER (ORDER BY c, p NULLS FIRST) AS id
            FROM (SELECT c, p FROM keyed EXCEPT SELECT c, p FROM first)),
        ids AS (SELECT * FROM first UNION ALL SELECT * FROM later)
        SELECT o_orderkey, id::BIGINT AS id FROM keyed k JOIN ids i ON k.c = i.c AND k.p IS NOT DISTINCT FROM i.p""",
    "load_order": """WITH RECURSIVE o AS (SELECT DISTINCT o_custkey AS c, o_custkey // 50 AS b, (o_custkey // 10) % 5 AS r FROM orders),
        refs AS (SELECT c, CASE WHEN c % 10 <> 0 THEN c - c % 10 WHEN r = 0 THEN b // 2 * 50 WHEN r = 4 THEN c WHEN r = 3 THEN c - 20
                 ELSE c + 10 END AS p FROM o UNION SELECT c, b * 50 FROM o WHERE c % 10 = 0 AND r = 1),
        e AS (SELECT DISTINCT concat('T', p) AS a, concat('T', c) AS b FROM refs),
        reach AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
        nodes AS (SELECT a AS node FROM e UNION SELECT b FROM e),
        parts AS (SELECT node, greatest(node, max(x.b)) AS root
                  FROM nodes LEFT JOIN (SELECT r.a, r.b FROM reach r JOIN reach q ON r.a = q.b AND r.b = q.a) x ON node = x.a GROUP BY node),
        dag AS (SELECT DISTINCT f.root AS a, t.root AS b FROM e JOIN parts f ON e.a = f.node JOIN parts t ON e.b = t.node WHERE f.root <> t.root),
        walks AS (SELECT DISTINCT root AS part, 0 AS n FROM parts UNION SELECT d.b, n + 1 FROM walks w JOIN dag d ON w.part = d.a),
        levels AS (SELECT part, max(n) AS n FROM walks GROUP BY part),
        circles AS (SELECT DISTINCT a FROM reach WHERE a = b)
        SELECT node AS table_name, n::INT AS load_level, CASE WHEN c.a IS NOT NULL THEN root END AS cycle, c.a IS NOT NULL AS in_cycle
        FROM parts JOIN levels ON root = part LEFT JOIN circles c ON node = c.a
        UNION ALL SELECT concat('T', c_custkey), 0, NULL, false FROM customer WHERE concat('T', c_custkey) NOT IN (SELECT node FROM nodes)""",
    "compare_content": """WITH theirs AS (SELECT * REPLACE (CASE WHEN l_partkey % 101 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity)
            FROM (SELECT * FROM lineitem WHERE l_orderkey % 97 <> 0 UNION ALL SELECT * REPLACE (-l_orderkey AS l_orderkey) FROM lineitem WHERE l_orderkey % 103 = 0)),
        a AS (SELECT l_orderkey AS k, l_linenumber AS n, count(*) AS rows_a, list_sort(list(t::VARCHAR)) AS content FROM lineitem t GROUP BY ALL),
        b AS (SELECT l_orderkey AS k, l_linenumber AS n, count(*) AS rows_b, list_sort(list(t::VARCHAR)) AS content FROM theirs t GROUP BY ALL)
        SELECT coalesce(a.k, b.k) AS l_orderkey, coalesce(a.n, b.n)::BIGINT AS l_linenumber, coalesce(rows_a, 0) AS source_rows, coalesce(rows_b, 0) AS target_rows,
          CASE WHEN rows_b IS NULL THEN 'lost' WHEN rows_a IS NULL THEN 'added' ELSE 'changed' END AS difference
        FROM a FULL JOIN b ON a.k = b.k AND a.n = b.n WHERE a.content IS DISTINCT FROM b.content""",
    "run_metadata": f"SELECT table_name, column_id, column_name, data_type FROM ({_described(['customer', 'orders', 'lineitem'])})",
    "run_views": """SELECT 'REGION' AS source_table_name, count(*) AS source_rows, 'TABLE' AS db_type, 'REGION' AS target_table_name,
          count(*) AS target_rows, 'Y' AS is_success FROM region
        UNION ALL SELECT concat('V', doc_id), NULL, 'VIEW', CASE WHEN found THEN concat('V', doc_id) ELSE 'NOT EXISTS VIEW' END, NULL,
          CASE WHEN found THEN 'Y' ELSE 'N' END
        FROM (SELECT doc_id, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS found FROM documents)""",
    "run_listed": """SELECT 'orders' AS table_name, count(*) AS source_table_rows, count(*) AS target_table_rows,
          'SUCCESS' AS run_detail FROM orders
        UNION ALL SELECT 'lineitem', count(*), count(*), 'SUCCESS' FROM lineitem""",
    "run_data": """SELECT 'CUSTOMER' AS source_table_name, count(*) AS source_rows, 'TABLE' AS db_type,
          'CUSTOMER' AS target_table_name, count(*) AS target_rows, 'Y' AS is_success FROM customer
        UNION ALL SELECT 'ORDERS', count(*), 'TABLE', 'ORDERS', count(*) FILTER (o_totalprice < 99999.995),
          CASE WHEN bool_and(o_totalprice < 99999.995) THEN 'Y' ELSE 'N' END FROM orders""",
    "ordered_list": """SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey) AS part_list
        FROM lineitem GROUP BY 1""",
    "ordered_parts": """SELECT l_returnflag, part, count(*) AS row_count, string_agg(l_partkey::VARCHAR, ',' ORDER BY n) AS part_list
        FROM (SELECT *, (n - 1) // 1000 AS part FROM (SELECT l_returnflag, l_partkey, row_number() OVER (PARTITION BY l_returnflag
          ORDER BY l_shipdate, l_orderkey, l_partkey) AS n FROM lineitem)) GROUP BY 1, 2""",
    "key_columns": f"""
        WITH t AS (SELECT concat('T', l_suppkey) AS table_name, l_orderkey, string_agg(concat('C', l_partkey), ','
            ORDER BY l_linenumber, concat('C', l_partkey)) AS columns FROM lineitem GROUP BY 1, 2),
        o AS (SELECT o_orderkey, o_totalprice, {", ".join(INDEX_FACTS)}, {CONSTRAINT_TYPE} FROM orders)
        SELECT table_name, concat('I', l_orderkey) AS index_name, columns,
          CASE WHEN o_totalprice > 200000 AND constraint_type = 'P' THEN 'PRIMARY KEY'
               WHEN o_totalprice > 200000 AND constraint_type = 'R' THEN 'FOREIGN KEY'
               WHEN uniqueness = 'UNIQUE' THEN 'UNIQUE' WHEN index_type = 'NORMAL' THEN 'PLAIN'
               ELSE index_type END AS key_class
        FROM t JOIN o ON l_orderkey = o_orderkey WHERE index_type <> 'FUNCTION-BASED NORMAL'""",
    "foreign_keys": f"""
        WITH l AS ({_FK_LISTS}), o AS (SELECT *, {CONSTRAINT_TYPE} FROM orders)
        SELECT concat('K', b.o_orderkey) AS constraint_name, concat('T', b.o_custkey) AS child_table,
          (SELECT cols FROM l WHERE k = concat('K', b.o_orderkey)) AS child_columns,
          (SELECT concat('T', p.o_custkey) FROM o p WHERE p.o_orderkey = b.o_custkey) AS parent_table,
          (SELECT cols FROM l WHERE k = concat('K', b.o_custkey)) AS parent_columns
        FROM o b WHERE b.constraint_type = 'R'""",
    "check_primary_key": """SELECT l_orderkey, l_linenumber, count(*) AS row_count, CASE WHEN l_orderkey IS NULL
          OR l_linenumber IS NULL THEN 'null' ELSE 'duplicate' END AS problem FROM lineitem GROUP BY 1, 2
        HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "check_unique": """SELECT md5(text) AS text_md5, count(*) AS row_count FROM documents WHERE text IS NOT NULL
        GROUP BY text HAVING count(*) > 1""",
    "check_not_null": """
        WITH j AS (SELECT * FROM orders LEFT JOIN labels ON o_orderkey = doc_id)
        SELECT 'o_orderkey' AS column_name, count(*) - count(o_orderkey) AS null_count FROM j
        UNION ALL SELECT 'o_custkey', count(*) - count(o_custkey) FROM j
        UNION ALL SELECT 'doc_id', count(*) - count(doc_id) FROM j
        UNION ALL SELECT 'quality', count(*) - count(quality) FROM j
        UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM j""",
    "orphan_rows": """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE NOT EXISTS
        (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'F')""",
    "orphan_summary": """SELECT l_orderkey, count(*) AS orphan_count FROM lineitem WHERE NOT EXISTS
        (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'F') GROUP BY 1""",
    "assign_ids": """
        WITH c AS (SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS id, c_name, c_mktsegment FROM customer)
        SELECT CASE WHEN id IS NOT NULL THEN id ELSE (SELECT max(id) FROM c)
            + row_number() OVER (PARTITION BY id IS NULL ORDER BY c_name) END AS c_custkey, c_name, c_mktsegment FROM c""",
    "text_between": """SELECT page_id, CASE WHEN instr(html, '<title>') > 0 AND instr(rest, '</title>') > 0
          THEN substr(rest, 1, instr(rest, '</title>') - 1) END AS title
        FROM (SELECT *, substr(html, instr(html, '<title>') + 7) AS rest FROM pages)""",
    "identity_columns": f"""
        SELECT DISTINCT table_name, substr(rest, 1, instr(rest, ' FROM DUAL;') - 1) AS column_name
        FROM (SELECT table_name, substr(body, instr(body, ':NEW.') + 5) AS rest FROM ({_TRIGGER_ROWS})
          WHERE trigger_type = 'BEFORE EACH ROW' AND body LIKE '%NEXTVAL%' AND body LIKE '%INTO :%'
            AND instr(body, ':NEW.') > 0)
        WHERE instr(rest, ' FROM DUAL;') > 0""",
    "identity_count": f"""SELECT count(*) AS identity_triggers FROM ({_TRIGGER_ROWS})
        WHERE trigger_type = 'BEFORE EACH ROW' AND upper(trigger_body) LIKE '%NEXTVAL%'""",
    "compare_counts": _COMPARE,
    "compare_failures": f"SELECT * FROM ({_COMPARE}) WHERE is_success = 'N' ORDER BY target_rows, target_table_name",
    "compare_keys": """SELECT c_custkey::VARCHAR AS source_key, CASE WHEN found THEN c_custkey::VARCHAR
          ELSE 'NOT EXISTS VIEW' END AS target_key, CASE WHEN found THEN 'Y' ELSE 'N' END AS is_success
        FROM (SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS found
          FROM customer)""",
    "exists_in": """SELECT count(DISTINCT user_id) AS found, 'click' AS event_type FROM events WHERE event_type = 'click'
        UNION ALL SELECT count(DISTINCT user_id), 'nosuch' FROM events WHERE event_type = 'nosuch'""",
    "object_status": """SELECT o_orderpriority AS kind, concat('customer ', o_custkey) AS name, o_orderstatus AS status,
          concat('order ', o_orderkey) AS message FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_orderpriority, o_custkey
          ORDER BY o_orderdate DESC, o_orderstatus DESC, concat('order ', o_orderkey) DESC) = 1""",
    "run_summary": """SELECT kind, count(*) AS total, count(*) FILTER (NOT bad) AS success,
          count(*) FILTER (bad) AS failed
        FROM (SELECT o_orderpriority AS kind, o_custkey, bool_and(o_orderstatus = 'F') AS bad FROM orders GROUP BY 1, 2)
        GROUP BY 1""",
    "count_by_kind": """SELECT p_type AS kind, count(*) AS total FROM part WHERE p_name NOT LIKE 'small%' GROUP BY 1""",
    "rewrite_text": _digest("replace(replace(replace(text, 'e', 'E'), 'Ea', 'ea'), '--', '-- -- ')"),
    "rewrite_views": _digest(
        f"""replace(replace(replace(replace(replace({VIEW_TEXT}, '--', '-- -- '), 'nvl(', 'ifnull('),
        concat('unistr(''', chr(92), '0030'')'), '0'), concat('unistr(''', chr(92), '0031'')'), '1'),
        concat('unistr(''', chr(92), '0033'')'), '3')"""),
    "rewrite_views_lexed": _digest(_lexed(VIEW_TEXT)),
    "normalise_text": _digest(
        f"""replace(replace(replace(replace(upper(replace({TRIGGER_TEXT}, 'ß', 'SS')), 'INTO:', 'INTO :'), 'SYS.DUAL ', 'DUAL'),
        'SYS.DUAL', 'DUAL'), chr(10), '')"""),
    "strip_definition": _digest(
        f"""trim(replace(regexp_replace(replace(CASE WHEN instr(upper({DEFINITION_TEXT}), ' PCTFREE') > 0
        THEN substr({DEFINITION_TEXT}, 1, instr(upper({DEFINITION_TEXT}), ' PCTFREE') - 1) END, '"', ''),
        '(^|[^A-Za-z0-9_$#])U\\.', '\\1', 'gi'), chr(10), ''))"""),
    "valid_only": "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)",
}
ORACLES["save_csv"] = ORACLES["run_summary"]
