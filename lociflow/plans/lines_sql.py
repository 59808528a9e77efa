"""SQL of the summary-statistics lines, with the quoting rules as patterns instead of a csv reader."""

from __future__ import annotations

#: The four single-character delimiters as regular expressions; white space has patterns of its own.
_DELIMITERS = {"tab": "\\t", "comma": ",", "semicolon": ";", "pipe": "\\|"}
_QUOTED = '"(?:[^"]|"")*"'


def _field(delimiter: str) -> str:
    """A quoted field, or an unquoted one, which doesn't start with a quote."""
    return f'(?: *{_QUOTED} *| *(?:[^" {delimiter}][^{delimiter}]*)?)'


_FIELDS = {name: (_field(d if d != "\\|" else "|"), d) for name, d in _DELIMITERS.items()} | {"blank": (f'(?:{_QUOTED}|[^" ][^ ]*)', " +")}


def _by_delimiter(made: str) -> str:
    cases = " ".join(f"WHEN '{name}' THEN " + made.replace("{field}", f).replace("{end}", d) for name, (f, d) in _FIELDS.items())
    return f"CASE delimiter {cases} END"


def _ended(text: str) -> str:
    """The text with every field, also the last, ended by a delimiter."""
    ends = {"tab": "chr(9)", "comma": "','", "semicolon": "';'", "pipe": "'|'"}
    plain = " ".join(f"WHEN '{name}' THEN replace({text}, chr(13), ' ') || {end}" for name, end in ends.items())
    return f"CASE delimiter {plain} ELSE trim(replace(replace({text}, chr(13), ' '), chr(9), ' ')) || ' ' END"


_COUNT = "len({t}) - len(replace({t}, {c}, ''))"
_COUNTS = [_COUNT.format(t="header", c=c) for c in ("chr(9)", "','", "';'", "'|'")]
_DELIMITER = f"""CASE greatest({", ".join(_COUNTS)}) WHEN 0 THEN 'blank' WHEN {_COUNTS[0]} THEN 'tab' WHEN {_COUNTS[1]} THEN 'comma' WHEN {_COUNTS[2]} THEN 'semicolon' ELSE 'pipe' END"""
_UNQUOTED = "list_transform({x}, lambda f: trim(CASE WHEN trim(f) LIKE '\"%' THEN replace(substr(trim(f), 2, len(trim(f)) - 2), '\"\"', '\"') ELSE f END))"
_NUMBER = "[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?"


def _number(text: str) -> str:
    """A plain number as double, null if it isn't one."""
    return f"CASE WHEN regexp_full_match({text}, '{_NUMBER}') THEN TRY_CAST(ltrim({text}, '+') AS DOUBLE) END"


def _at(canonical: str) -> str:
    """The field of the first column of that canonical name, null without one."""
    return f"fields[list_position(canonical, '{canonical}')]"


#: CTEs up to parsed: line_id, file_id, line_no, valid quoting, fields, canonical column names.
PARSED = f"""
    cleaned AS (SELECT file_id, line_id, line_no, regexp_replace(regexp_replace(coalesce(line, ''), '^﻿', ''), '[\\r\\n]+$', '') AS text FROM gwas_lines),
    content AS (SELECT * FROM cleaned WHERE trim(translate(text, chr(9) || chr(13) || '﻿', '   ')) <> '' AND NOT regexp_matches(text, '^#[# \\t]')),
    heads AS (SELECT file_id, line_id AS head_id, ltrim(text, '﻿') AS header FROM content QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY line_no, line_id) = 1),
    dialects AS (SELECT *, {_DELIMITER} AS delimiter FROM heads),
    ended_heads AS (SELECT *, {_ended("ltrim(header, '#')")} AS ended FROM dialects),
    named AS (SELECT file_id, head_id, delimiter, list_transform({_by_delimiter("regexp_extract_all(ended, '({field}){end}', 1)")},
                lambda f: upper(ltrim(regexp_replace(f, '[\\s"''﻿]', '', 'g'), '#'))) AS names FROM ended_heads),
    places AS (SELECT file_id, unnest(names) AS name, generate_subscripts(names, 1) AS i FROM named),
    canon AS (SELECT file_id, list(coalesce(a.canonical, name) ORDER BY i) AS canonical FROM places LEFT JOIN (SELECT upper(alias) AS alias, min(canonical) AS canonical FROM column_aliases GROUP BY 1) a ON a.alias = name GROUP BY file_id),
    ended_lines AS (SELECT line_id, c.file_id, line_no, n.delimiter, k.canonical, {_ended("text")} AS ended FROM content c JOIN named n ON n.file_id = c.file_id AND n.head_id <> c.line_id JOIN canon k ON k.file_id = c.file_id),
    parsed AS (SELECT *, {_by_delimiter("regexp_full_match(ended, '(?:{field}{end})+')")} AS valid,
                {_UNQUOTED.format(x=_by_delimiter("regexp_extract_all(ended, '({field}){end}', 1)"))} AS fields FROM ended_lines),
    valued AS (SELECT *, {_at("CHR")} AS chrom, {_number(_at("P"))} AS p, coalesce({_number(f"CASE WHEN list_contains(canonical, 'BETA') THEN {_at('BETA')} ELSE {_at('OR')} END")}, 'inf') AS effect FROM parsed),
    reasons AS (SELECT *, CASE WHEN NOT valid THEN 'quoting' WHEN len(fields) <> len(canonical) THEN 'columns'
                WHEN NOT coalesce(regexp_full_match(lower(chrom), '(chr)?0*([1-9]|1[0-9]|2[0-2])'), false) THEN 'chr'
                WHEN NOT coalesce(p BETWEEN 0 AND 1, false) THEN 'p'
                WHEN NOT isfinite(effect) OR (effect <= 0 AND NOT list_contains(canonical, 'BETA')) THEN 'beta' END AS reason FROM valued)"""

P4_FOUND = f"WITH {PARSED} SELECT line_id, reason FROM reasons WHERE reason IS NOT NULL"


def _text(canonical: str) -> str:
    """A field's text, null where it is empty or stands for nothing."""
    return f"CASE WHEN upper({_at(canonical)}) NOT IN ('', 'NA', 'NAN', '.') THEN {_at(canonical)} END"


def _double(canonical: str) -> str:
    return f"TRY_CAST({_text(canonical)} AS DOUBLE)"


P4_ROWS = f"""WITH {PARSED} SELECT line_id, file_id, {_text("SNP")} AS "SNP", TRY_CAST(regexp_replace(lower(chrom), '^chr', '') AS INT) AS "CHR", TRY_CAST(trunc({_double("POS")}) AS BIGINT) AS "POS",
    upper({_text("A1")}) AS "A1", upper({_text("A2")}) AS "A2", CASE WHEN list_contains(canonical, 'BETA') THEN {_double("BETA")} WHEN {_double("OR")} > 0 THEN ln({_double("OR")}) END AS "BETA",
    {_double("SE")} AS "SE", {_double("P")} AS "P", TRY_CAST(round({_double("N")}) AS BIGINT) AS "N", {_double("MAF")} AS "MAF", {_double("INFO")} AS "INFO" FROM reasons WHERE reason IS NULL"""

#: CTEs up to steps: each file's columns beside those of the file received before it in its stream.
_STEPS = f"""{PARSED},
    cols AS (SELECT p.file_id, i, name AS header, coalesce(a.canonical, name) AS field FROM places p LEFT JOIN (SELECT upper(alias) AS alias, min(canonical) AS canonical FROM column_aliases GROUP BY 1) a ON a.alias = name
             WHERE name <> '' QUALIFY row_number() OVER (PARTITION BY file_id, coalesce(a.canonical, name) ORDER BY i) = 1),
    vals AS (SELECT file_id, generate_subscripts(fields, 1) AS i, unnest(fields) AS v FROM parsed WHERE valid AND len(fields) = len(canonical)),
    kinds AS (SELECT file_id, i, count(*) AS n, count(*) FILTER (regexp_full_match(v, '[+-]?[0-9]+')) AS ints, count(*) FILTER (regexp_full_match(v, '{_NUMBER}')) AS numbers FROM vals WHERE upper(v) NOT IN ('', 'NA') GROUP BY file_id, i),
    types AS (SELECT file_id, i, CASE WHEN ints * 2 > n THEN 'int' WHEN (numbers - ints) * 2 > n THEN 'float' WHEN (n - numbers) * 2 > n THEN 'text' END AS type FROM kinds),
    layout AS (SELECT c.file_id, field, header, type FROM cols c LEFT JOIN types t USING (file_id, i)),
    turns AS (SELECT f.file_id, delimiter, header LIKE '#%' AS hashed, lag(f.file_id) OVER w AS prev, lag(delimiter) OVER w AS prev_delimiter, lag(header LIKE '#%') OVER w AS prev_hashed
              FROM gwas_files f JOIN dialects USING (file_id) WINDOW w AS (PARTITION BY stream ORDER BY received_at NULLS FIRST, f.file_id)),
    new_ AS (SELECT t.file_id, l.field, l.header, l.type FROM turns t JOIN layout l USING (file_id) WHERE prev IS NOT NULL),
    old_ AS (SELECT t.file_id, l.field, l.header, l.type FROM turns t JOIN layout l ON l.file_id = t.prev),
    steps AS (SELECT coalesce(n.file_id, o.file_id) AS file_id, coalesce(n.field, o.field) AS field, n.header AS new_header, o.header AS old_header, n.type AS new_type, o.type AS old_type
              FROM new_ n FULL JOIN old_ o ON n.file_id = o.file_id AND n.field = o.field)"""

P6_FOUND = f"""WITH {_STEPS}
    SELECT file_id, field, CASE WHEN old_header IS NULL THEN 'added' ELSE 'removed' END AS change FROM steps WHERE old_header IS NULL OR new_header IS NULL
    UNION ALL SELECT file_id, field, 'renamed' FROM steps WHERE old_header <> new_header
    UNION ALL SELECT file_id, field, 'retyped' FROM steps WHERE old_type <> new_type
    UNION ALL SELECT file_id, 'delimiter', 'changed' FROM turns WHERE delimiter <> prev_delimiter
    UNION ALL SELECT file_id, 'header_starts_with_hash', 'changed' FROM turns WHERE hashed <> prev_hashed"""
