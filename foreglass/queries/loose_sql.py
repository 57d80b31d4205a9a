"""JSON texts in loose notations as SQL, for the oracles: the counterpart of ``functions.loosejson``, written apart from it."""

from __future__ import annotations

#: A string in either kind of quotes, or what stands between strings.
_TOKENS = r"""'(?:[^''\\]|\\.)*''|"(?:[^"\\]|\\.)*"|[^''"]+"""


def _plain(text: str) -> str:
    """A text in single-quoted notation with None, True and False as JSON."""
    single = """'"' || replace(replace(t[2:-2], '\\''', ''''), '"', '\\"') || '"'"""
    other = "regexp_replace(regexp_replace(regexp_replace(t, '\\bNone\\b', 'null', 'g'), '\\bTrue\\b', 'true', 'g'), '\\bFalse\\b', 'false', 'g')"
    return f"""array_to_string(list_transform(regexp_extract_all({text}, '{_TOKENS.replace("'(?:[^''", "''(?:[^''", 1)}'), lambda t: case when t[1] = '''' then {single} when t[1] = '"' then t else {other} end), '')"""


def loose(name: str, rows: str, column: str, layers: int = 3) -> str:
    """Common table expressions that end with ``name``: ``rows`` with ``j``, the column as JSON, null where it is not whole."""
    steps = [f"{name}_0 as (select *, {column} t0 from ({rows}))"]
    for i in range(layers):
        bare = "regexp_replace({}, '^[﻿ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g')"
        steps.append(f"{name}_{i}a as (select *, {bare.format(f't{i}')} s{i} from {name}_{i})")
        steps.append(f"{name}_{i}b as (select *, case when s{i} like '`%' then {bare.format(f'''regexp_extract(s{i}, '(?s)^```[\\w-]*\\s*\\n?(.*?)\\n?\\s*```$', 1)''')} else s{i} end f{i} from {name}_{i}a)")
        steps.append(f"{name}_{i + 1} as (select *, case when f{i} like '\"%' and json_valid(f{i}) then json_extract_string(f{i}, '$') else f{i} end t{i + 1} from {name}_{i}b)")
    last = f"t{layers}"
    steps.append(f"{name}_x as (select *, case when json_valid({last}) then {last} else regexp_replace({last}, ',(\\s*[}}\\]])', '\\1', 'g') end x from {name}_{layers})")
    steps.append(f"{name}_y as (select *, case when json_valid(x) then x when right(x, 1) in ('}}', ']') and contains(x, '''') then {_plain('x')} end y from {name}_x)")
    steps.append(f"{name} as (select *, case when json_valid(y) then y::json end j from {name}_y)")
    return ",\n ".join(steps)


def elements(json: str, key: str, scalar: str | None = None) -> str:
    """A list of ``{key, value}`` of the elements of a JSON array or object: the key as text, the element as JSON."""
    of_array = f"list_transform(cast({json} as json[]), lambda el: {{'key': case when json_type(el) = 'OBJECT' then el->>'{key}' {'' if scalar else 'else el->>' + chr(39) + '$' + chr(39)} end, 'value': el}})"
    of_object = f"list_transform(map_entries(cast({json} as map(varchar, json))), lambda el: {{'key': el.key, 'value': el.value}})"
    return f"case json_type({json}) when 'ARRAY' then {of_array} when 'OBJECT' then {of_object} else [] end"
