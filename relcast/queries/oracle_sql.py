"""SQL building blocks for the DuckDB oracles (independent re-statements of each rule)."""

from __future__ import annotations

from relcast.queries.fixtures import CCN_CODES


def soundex_sql(w: str) -> str:
    """American Soundex in DuckDB SQL (DuckDB has no soundex).

    Letters are coded; H and W are skipped without breaking a run; any other
    character (vowels, Y, non-letters) breaks a run; runs of one code collapse;
    the first letter's own code is dropped; pad to three digits.
    """
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    codes = "01230127022455012623017202"
    coded = f"translate(regexp_replace(upper({w}), '[^A-Z]', '0', 'g'), '{letters}', '{codes}')"
    seq = f"(left({coded}, 1) || replace(substr({coded}, 2), '7', ''))"
    for d in "0123456":
        seq = f"regexp_replace({seq}, '{d}+', '{d}', 'g')"
    digits = f"rpad(left(replace(substr({seq}, 2), '0', ''), 3), 3, '0')"
    return (
        f"(CASE WHEN {w} IS NULL THEN NULL WHEN NOT regexp_matches({w}, '^[A-Za-z]') THEN {w} "
        f"ELSE upper(left({w}, 1)) || {digits} END)"
    )


def ccn_remap_sql(c: str) -> str:
    """The CCN rules, spelled out here so that a wrong production rule cannot agree with itself."""
    return f"""(CASE
        WHEN {c} IS NULL THEN ''
        WHEN length({c}) < 4 THEN {c}
        WHEN regexp_matches({c}, '^..[MRZ][0-9]') THEN left({c}, 2) || '1' || substr({c}, 4, 3)
        WHEN regexp_matches({c}, '^..[STU][0-9]') THEN left({c}, 2) || '0' || substr({c}, 4, 3)
        WHEN regexp_matches({c}, '^..W[0-9]') THEN left({c}, 2) || '2' || substr({c}, 4, 3)
        WHEN regexp_matches({c}, '^..Y[0-9]') THEN left({c}, 2) || '3' || substr({c}, 4, 3)
        WHEN regexp_matches({c}, '^..[ST]A') THEN left({c}, 2) || '20' || substr({c}, 5, 2)
        WHEN regexp_matches({c}, '^..[ST]B') THEN left({c}, 2) || '21' || substr({c}, 5, 2)
        WHEN regexp_matches({c}, '^..[ST]C') THEN left({c}, 2) || '22' || substr({c}, 5, 2)
        WHEN regexp_matches({c}, '^..SD') THEN left({c}, 2) || '30' || substr({c}, 5, 2)
        WHEN regexp_matches({c}, '^..[ST]E') THEN left({c}, 2) || '33' || substr({c}, 5, 2)
        WHEN regexp_matches({c}, '^..TF') THEN left({c}, 2) || '40' || substr({c}, 5, 2)
        WHEN regexp_matches({c}, '^..TG') THEN left({c}, 2) || '41' || substr({c}, 5, 2)
        WHEN regexp_matches({c}, '^..TH') THEN left({c}, 2) || '42' || substr({c}, 5, 2)
        WHEN regexp_matches({c}, '^..TJ') THEN left({c}, 2) || '43' || substr({c}, 5, 2)
        WHEN regexp_matches({c}, '^..TK') THEN left({c}, 2) || '44' || substr({c}, 5, 2)
        ELSE left({c}, 6) END)"""


def synthetic_ccn_sql(state_num: str, key: str) -> str:
    codes = "[" + ", ".join("'" + c + "'" for c in CCN_CODES) + "]"
    return (
        f"(lpad(CAST({state_num} AS VARCHAR), 2, '0') || ({codes})[CAST(({key}) % {len(CCN_CODES)} AS INTEGER) + 1] "
        f"|| lpad(CAST(({key}) % 1000 AS VARCHAR), 4, '0'))"
    )


def dirty_word_sql(name: str, key: str) -> str:
    """Deterministic typos: drop the 3rd letter, swap letters 2 and 3, double the 4th; some nulls."""
    return (
        f"(CASE WHEN {key} % 23 = 0 THEN NULL "
        f"WHEN {key} % 17 = 0 THEN substr({name}, 1, 2) || substr({name}, 4) "
        f"WHEN {key} % 17 = 1 THEN substr({name}, 1, 1) || substr({name}, 3, 1) || substr({name}, 2, 1) || substr({name}, 4) "
        f"WHEN {key} % 17 = 2 THEN substr({name}, 1, 4) || substr({name}, 4) "
        f"ELSE {name} END)"
    )
