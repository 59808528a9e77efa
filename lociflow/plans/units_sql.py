"""SQL of the converted effects and frequencies: every form a report writes them in, by text, then note, then study."""

from __future__ import annotations

_TIDY = "lower(trim(regexp_replace(replace(coalesce({c}, ''), '−', '-'), '([0-9]),([0-9])', '\\1.\\2', 'g')))"
_NUMBER = "TRY_CAST(ltrim(regexp_extract({t}, '[+-]?([0-9]+(\\.[0-9]+)?|\\.[0-9]+)'), '+') AS DOUBLE)"
_UNREPORTED = "('', '-', '.', 'na', 'n/a', 'nr', 'nan', 'null', 'none', 'not reported')"
_UNIT = """CASE WHEN {t} LIKE '%log10%' THEN 'log10' WHEN {t} LIKE '%log2%' THEN 'log2' WHEN regexp_matches({t}, '(x|by|per) ?1000|10 ?\\^ ?-3|e-3 ?\\(') THEN 'thousandths'
    WHEN regexp_matches({t}, '%|per ?cent') THEN 'percent' WHEN regexp_matches({t}, 'log|\\bln\\b|beta|β') THEN 'ln' WHEN regexp_matches({t}, 'odds|\\bor\\b|fold') THEN 'ratio' END"""
_PAIR = "^(one|[0-9.]+) ?(?:/|:|of|in|per) ?([0-9.]+)"
_SCALE = "CASE WHEN regexp_matches({t}, '‰|per (1000|thousand)') THEN 1000 WHEN regexp_matches({t}, '%|per ?cent') THEN 100 END"
_PLAIN = "CASE WHEN regexp_full_match(trim(raw), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)') THEN CAST(ltrim(trim(raw), '+') AS DOUBLE) END"

P2_FOUND = f"""WITH h AS (SELECT row_id, study_id, beta, maf, trim(regexp_replace({_TIDY.format(c="beta")}, '\\[.*$|\\([0-9]+% ci.*$', '')) AS b, {_TIDY.format(c="beta_note")} AS bn,
        {_TIDY.format(c="maf")} AS m, {_TIDY.format(c="maf_note")} AS mn FROM assoc_hits),
    b1 AS (SELECT row_id, beta AS raw, coalesce({_UNIT.format(t="b")}, {_UNIT.format(t="bn")}, CASE WHEN s.has_or THEN 'ratio' WHEN NOT s.has_or THEN 'ln' END) AS unit,
        {_NUMBER.format(t="regexp_replace(b, 'log(10|2)', '')")} * CASE WHEN regexp_matches(b, 'lower|reduced') THEN -1 ELSE 1 END AS x
        FROM h LEFT JOIN gwas_studies s USING (study_id) WHERE b NOT IN {_UNREPORTED}),
    b2 AS (SELECT row_id, 'beta' AS field, raw, CASE unit WHEN 'ln' THEN x WHEN 'thousandths' THEN x / 1000 WHEN 'log10' THEN x * ln(10) WHEN 'log2' THEN x * ln(2)
        WHEN 'ratio' THEN CASE WHEN x > 0 THEN ln(x) END WHEN 'percent' THEN CASE WHEN x > -100 THEN ln(1 + x / 100) END END AS v FROM b1),
    m1 AS (SELECT row_id, maf AS raw, CASE WHEN m LIKE 'ac=%' THEN TRY_CAST(regexp_extract(m, 'ac=([0-9]+)', 1) AS DOUBLE) / TRY_CAST(regexp_extract(m, 'an=([0-9]+)', 1) AS DOUBLE)
        WHEN regexp_matches(m, '{_PAIR}') THEN TRY_CAST(replace(regexp_extract(m, '{_PAIR}', 1), 'one', '1') AS DOUBLE) / TRY_CAST(regexp_extract(m, '{_PAIR}', 2) AS DOUBLE)
        ELSE {_NUMBER.format(t="m")} / coalesce({_SCALE.format(t="m")}, {_SCALE.format(t="mn")}, 1) END AS f FROM h WHERE m NOT IN {_UNREPORTED}),
    every AS (SELECT * FROM b2 UNION ALL SELECT row_id, 'maf', raw, CASE WHEN f BETWEEN 0 AND 1 THEN least(f, 1 - f) END FROM m1)
    SELECT row_id, field, CAST(round(round(v * 1000, 7)) AS BIGINT) AS value_milli FROM every WHERE v IS NOT NULL AND coalesce(abs({_PLAIN} - v) > 1e-9, true)"""
