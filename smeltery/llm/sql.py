"""SQL of queries that repeat a step for each level or bit."""

from __future__ import annotations

#: crc32 of the UTF-8 text ``{text}``, bit by bit.
_CRC32 = """xor(4294967295::ubigint, list_reduce(list_prepend(4294967295::ubigint,
    list_transform(range(0, strlen({text})::bigint),
        lambda k: ('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::ubigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::ubigint, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, y: xor(x >> 1, 3988292384::ubigint * (x & 1)))))"""


def crc32(text: str) -> str:
    return _CRC32.format(text=text)


def _counted(value: str) -> str:
    return f"coalesce(strlen({value}::varchar) || ':' || {value}::varchar, '-')"


def _tree(name: str, source: str, levels: int) -> list[str]:
    """Nodes (g, i, h, n) of each level above ``source``, and the siblings of each node."""
    found = [f"{name}0 as ({source})"]
    for k in range(levels):
        run = "partition by g, i // 8 order by i rows between"
        found.append(
            f"""{name}_near{k} as (select g, i,
                coalesce(string_agg(h, '') over ({run} unbounded preceding and 1 preceding), '') as l,
                coalesce(string_agg(h, '') over ({run} 1 following and unbounded following), '') as r
                from {name}{k} where n > 1)"""
        )
        found.append(
            f"""{name}{k + 1} as (
                select g, i // 8 as i, sha256(string_agg(h, '' order by i)) as h, (n + 7) // 8 as n
                from {name}{k} where n > 1 group by g, i // 8, n
                union all select g, i, h, n from {name}{k} where n = 1)"""
        )
    return found


def _climb(name: str, source: str, levels: int, tree: str) -> list[str]:
    """Paths (rid, g, i, f, p): the folded digest and the siblings so far."""
    found = [f"{name}0 as ({source})"]
    for k in range(levels):
        found.append(
            f"""{name}{k + 1} as (select rid, a.g, a.i // 8 as i,
                case when s.l is null then f else sha256(s.l || f || s.r) end as f,
                p || coalesce(s.l || s.r, '') as p
                from {name}{k} a left join {tree}_near{k} s on a.g = s.g and a.i = s.i)"""
        )
    return found


def merkle(levels: int = 7, levels_of_groups: int = 3) -> str:
    """The manifest of ``documents``: up to 8 ** ``levels`` rows of a language."""
    fields = ["doc_id", "source", "lang", "n_chars"]
    plain = " || ".join(map(_counted, [*fields, "text"]))
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    tampered = " || ".join(map(_counted, [*fields, low]))
    drawn = f"doc_id is not null and {crc32('doc_id::varchar')} % 3 = 0"
    steps = [
        f"""leaf as (select row_number() over () as rid, doc_id, coalesce('=' || lang, '') as g,
            sha256({plain}) as h, case when {drawn} then sha256({tampered}) else sha256({plain}) end as t
            from documents)""",
        """spot as (select *, row_number() over (partition by g order by doc_id nulls first, h) - 1 as i,
            count(*) over (partition by g) as n from leaf)""",
        *_tree("node", "select g, i, h, n from spot", levels),
        f"""tops as (select '' as g, row_number() over (order by g) - 1 as i, h, count(*) over () as n,
            g as name from node{levels})""",
        *_tree("top", "select g, i, h, n from tops", levels_of_groups),
        *_climb("path", "select rid, g, i, t as f, '' as p from spot", levels, "node"),
        *_climb(
            "way",
            f"select rid, '' as g, t.i, f, p from path{levels} a join tops t on a.g = t.name",
            levels_of_groups,
            "top",
        ),
    ]
    return f"""
        with {", ".join(steps)}
        select doc_id, x.h as leaf, t.h as subroot, r.h as root, sha256(w.p) as proof_sha256,
               w.f as folded_root, w.f = r.h as verified
        from spot x join way{levels_of_groups} w using (rid) join tops t on x.g = t.name
        cross join top{levels_of_groups} r"""


#: Words, forms and roots of ``documents``: near words share what is around a hole.
SPELLING = rf"""
    with recursive run as (
        select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) as r
        from documents),
    low as (
        select coalesce(doc_id::varchar, '') as id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') as r, count(*) as c
        from run where length(r) >= 7 group by 1, 2),
    hashed as (select r, c, {crc32("(id || ':' || r)")} as h from low),
    changed as (
        select case when h % 31 = 0
            then substr(r, 1, (h % length(r))::bigint) || substr(r, (h % length(r))::bigint + 2)
            else r end as word, c from hashed),
    words as (
        select word, sum(c)::bigint as n from changed where length(word) >= 7
        group by word having sum(c) >= 2),
    holes as (
        select word, n, i, substr(word, 1, i - 1) as a, substr(word, i + 1) as b
        from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
    pairs as (
        select x.word, y.word as other, y.n from holes x join holes y using (i, a, b) where x.word != y.word
        union select x.word, y.word, y.n from holes x join words y on x.a || x.b = y.word
        union select y.word, x.word, x.n from holes x join words y on x.a || x.b = y.word),
    ranked as (
        select word, other, n, count(*) over (partition by word) as n_near,
            row_number() over (partition by word order by n desc, other) as k from pairs),
    told as (
        select w.word, w.n, coalesce(n_near, 0) as n_near,
            case when p.n >= 10 * w.n then other end as form, case when p.n >= 10 * w.n then p.n end as form_n
        from words w left join ranked p on p.word = w.word and k = 1),
    way as (
        select word, word as root from told where form is null
        union all select told.word, way.root from told join way on told.form = way.word)
    select word, form, root, n, n_near, form_n from told join way using (word)"""
