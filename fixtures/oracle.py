"""DuckDB SQL for the same results, written independently of the DataFrame code."""

from __future__ import annotations

import re

from fixtures.derived import RAW_CTES
from personweave.functions.nicknames import NICKNAMES


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            "lambda w: upper(w[1:1]) || lower(w[2:])), ' ')")


def gamma_exact(f: str, l: str = "l", r: str = "r") -> str:
    return f"case when {l}.n_{f} is null or {r}.n_{f} is null then -1 when {l}.n_{f} = {r}.n_{f} then 1 else 0 end"


def gamma_fuzzy(f: str, l: str = "l", r: str = "r") -> str:
    return (f"case when {l}.n_{f} is null or {r}.n_{f} is null then -1 "
            f"when jaro_winkler_similarity({l}.n_{f}, {r}.n_{f}) >= 0.88 then 1 else 0 end")


def gammas(l: str = "l", r: str = "r") -> str:
    return ", ".join(
        [f"{gamma_exact(f, l, r)} as gamma_{f}" for f in ("email", "phone")]
        + [f"{gamma_fuzzy(f, l, r)} as gamma_{f}" for f in ("first_name", "last_name", "company_name")])


# Declared weight, m and u of every field, thresholds, sources and their priorities.
PARAMETERS = {"email": (2.0, 0.95, 0.001), "phone": (1.5, 0.85, 0.005), "first_name": (1.0, 0.85, 0.05),
              "last_name": (1.0, 0.88, 0.02), "company_name": (1.0, 0.80, 0.02)}
WEIGHT = " + ".join(
    f"case gamma_{f} when 1 then {w} * log2({m} / {u}) when 0 then {w} * log2((1 - {m}) / (1 - {u})) else 0 end"
    for f, (w, m, u) in PARAMETERS.items())
SELF_WEIGHT = " + ".join(
    f"case when n_{f} is not null then {w} * log2({m} / {u}) else 0 end" for f, (w, m, u) in PARAMETERS.items())
HAS_KEY = ("(n_email is not null or n_phone is not null or (n_last_name is not null and n_first_name is not null) "
           "or (n_company_name is not null and n_last_name is not null))")
HAS_INCREMENTAL_KEY = "(n_email is not null or n_phone is not null or (n_last_name is not null and n_first_name is not null))"
COPIES_MATCH = f"({SELF_WEIGHT}) >= 8 and {HAS_KEY}"
CONFIDENCE = ("case when weight >= 8 then 1 - 0.1 * pow(2.0, 8 - weight) when weight >= 4 then 0.7 + 0.2 * (weight - 4) / 4 "
              "when weight > -5 then 0.7 * (weight + 5) / 9 else 0 end")
SOURCES = ("crm_contacts", "billing_accounts", "support_users", "app_signups", "partner_leads")


def rank(order: tuple[str, ...]) -> str:
    return "case source_system " + " ".join(f"when '{s}' then {i}" for i, s in enumerate(order)) + " else 1000000 end"


def complete(a: str) -> str:
    v = f"nullif(trim({a}), '')"
    return (f"arg_min({v}, row(-length({v}), {rank(SOURCES)}, source_system, external_id)) "
            f"filter (where {v} is not null)")


def by_priority(a: str, order: tuple[str, ...]) -> str:
    v = f"nullif(trim({a}), '')"
    return (f"arg_min({v}, row({rank(order)}, {rank(SOURCES)}, source_system, external_id)) "
            f"filter (where {v} is not null)")


def normal(prefix: str = "") -> str:
    """Normalised columns of a table with the staged attributes, joined with `nick` for the first name."""
    clean = f"nullif(trim(regexp_replace(regexp_replace(lower({prefix}{{0}}), '[^\\p{{{{L}}}}\\p{{{{N}}}}\\s]', '', 'g'), '\\s+', ' ', 'g')), '')"
    name = lambda c: clean.replace("{{", "{").replace("}}", "}").replace("{0}", c)
    return f"""
      nullif(regexp_replace(lower(trim({prefix}email)), '\\+[^@]*@', '@', 'g'), '') as n_email,
      nullif(case when length(regexp_replace({prefix}phone, '[^0-9]', '', 'g')) = 11
                   and regexp_replace({prefix}phone, '[^0-9]', '', 'g') like '1%'
                  then substr(regexp_replace({prefix}phone, '[^0-9]', '', 'g'), 2)
                  else regexp_replace({prefix}phone, '[^0-9]', '', 'g') end, '') as n_phone,
      coalesce((select formal from nick where alias = {name('first_name')}), {name('first_name')}) as n_first_name,
      {name('last_name')} as n_last_name,
      nullif(trim(regexp_replace(lower({prefix}company_name), '\\s+', ' ', 'g')), '') as n_company_name"""


STAGED = "external_id, source_system, email, phone, first_name, last_name, company_name"
N = "n_email, n_phone, n_first_name, n_last_name, n_company_name"

CTES: dict[str, str] = {}
CTES["crm"] = "select external_id as crm_contact_id, email, first_name, last_name, phone, company_name from raw where s = 0"
CTES["billing"] = "select external_id as billing_account_id, email, account_name, company_name from raw where s = 1"
CTES["support"] = "select external_id as support_user_id, email, display_name, phone, company_name as company from raw where s = 2"
CTES["app"] = "select external_id as app_user_id, email, first_name, last_name from raw where s = 3"
CTES["partner"] = "select external_id as partner_lead_id, email, first_name, last_name, company_name as company from raw where s = 4"


def staged_sql(source: str, table: str, key: str, first: str, last: str, company: str, keep: str, phone: str = "null") -> str:
    """One staged source; names in title case."""
    return f"""select {key} as external_id, '{source}' as source_system, lower(trim(email)) as email,
  cast({phone} as varchar) as phone, {initcap(f'trim({first})')} as first_name, {initcap(f'trim({last})')} as last_name,
  cast({company} as varchar) as company_name from {table} where {keep}"""


DIGITS = "regexp_replace(phone, '\\D', '', 'g')"
# "Last, First", else the text before and after the first blank; without a blank both are the whole text.
BEFORE, AFTER = "regexp_extract({0}, '^[^ ]*')", "regexp_replace({0}, '^[^ ]* ', '')"
BY_COMMA = [f"case when contains(account_name, ',') then regexp_extract(account_name, '^([^,]*),([^,]*)', {i}) else {other.format('account_name')} end"
            for i, other in ((2, BEFORE), (1, AFTER))]
CTES["stg_crm"] = staged_sql("crm_contacts", "crm", "crm_contact_id", "first_name", "last_name", "trim(company_name)",
                             "coalesce(email, phone) is not null", DIGITS)
CTES["stg_billing"] = staged_sql("billing_accounts", "billing", "billing_account_id", *BY_COMMA, "trim(company_name)", "email is not null")
CTES["stg_support"] = staged_sql("support_users", "support", "support_user_id", BEFORE.format("display_name"),
                                 AFTER.format("display_name"), initcap("trim(company)"), "coalesce(email, phone) is not null", DIGITS)
CTES["stg_app"] = staged_sql("app_signups", "app", "app_user_id", "first_name", "last_name", "null", "email is not null")
CTES["stg_partner"] = staged_sql("partner_leads", "partner", "partner_lead_id", "first_name", "last_name", "trim(company)",
                                 "coalesce(email, first_name) is not null")
CTES["unified"] = " union all ".join(f"select * from stg_{s}" for s in ("crm", "billing", "support", "app", "partner"))
CTES["nick"] = "select * from (values " + ", ".join(f"('{a}', '{b}')" for a, b in NICKNAMES.items()) + ") t(alias, formal)"
CTES["norm"] = f"select source_system || ':' || external_id as rec_id, {STAGED}, {normal()} from unified"
# Copies share a profile if they would match each other; else a record has its own.
CTES["normal"] = f"select *, case when {COPIES_MATCH} then '' else rec_id end as own from norm"
CTES["prof"] = f"select min(rec_id) as vid, count(*) as n, {N}, own from normal group by {N}, own"
KEY_SQL = """select {id}, 'email' as key_type, n_email as key_value from {t} where n_email is not null
  union all select {id}, 'phone', n_phone from {t} where n_phone is not null
  union all select {id}, 'last_name+first_name', n_last_name || chr(31) || n_first_name from {t}
    where n_last_name is not null and n_first_name is not null
  union all select {id}, 'company_name+last_name', n_company_name || chr(31) || n_last_name from {t}
    where n_company_name is not null and n_last_name is not null"""
INCREMENTAL_KEY_SQL = """select {id}, 'email' as key_type, n_email as key_value from {t} where n_email is not null
  union all select {id}, 'phone', n_phone from {t} where n_phone is not null
  union all select {id}, 'name3', substr(n_first_name, 1, 3) || n_last_name from {t}
    where n_last_name is not null and n_first_name is not null"""
CTES["keys"] = KEY_SQL.format(id="vid", t="prof")
CTES["pairs"] = """select a.vid as left_id, b.vid as right_id, string_agg(a.key_type, ',' order by a.key_type) as key_types
  from keys a join keys b on a.key_type = b.key_type and a.key_value = b.key_value and a.vid < b.vid group by 1, 2"""
CTES["compared"] = f"""select left_id, right_id, key_types, l.n as n_left, r.n as n_right, {gammas()} from pairs
  join prof l on l.vid = left_id join prof r on r.vid = right_id"""
CTES["weighed"] = f"select *, {WEIGHT} as weight from compared"
CTES["scored"] = f"select *, {CONFIDENCE} as confidence from weighed where weight >= 4"
CTES["decided"] = """select *, case when weight >= 8 then 'match' when weight >= 4 then 'possible'
    when weight >= -5 then 'unlikely' else 'non_match' end as class,
  case when confidence >= 0.9 then 'match' when confidence >= 0.7 then 'review' else 'reject' end as decision from scored"""
CTES["links"] = "select left_id, right_id from scored where weight >= 8"
CTES["edges"] = "select left_id as a, right_id as b from links union select right_id, left_id from links"
CTES["reach"] = """select vid, vid as seen from prof union select edges.b, reach.seen from reach join edges on edges.a = reach.vid
  where reach.seen < edges.b"""
CTES["comp"] = "select vid, min(seen) as component from reach group by vid"
CTES["members"] = """select m.* exclude (own), sha256(c.component) as entity_id from normal m
  join prof p on m.own = p.own and m.n_email is not distinct from p.n_email and m.n_phone is not distinct from p.n_phone
   and m.n_first_name is not distinct from p.n_first_name and m.n_last_name is not distinct from p.n_last_name
   and m.n_company_name is not distinct from p.n_company_name
  join comp c on c.vid = p.vid"""
CTES["survived"] = f"""select entity_id, {complete('first_name')} as first_name, {complete('last_name')} as last_name,
  {complete('email')} as email, {by_priority('phone', ('crm_contacts', 'support_users'))} as phone,
  {by_priority('company_name', ('crm_contacts', 'billing_accounts', 'partner_leads'))} as company_name,
  arg_min(source_system, row({rank(SOURCES)}, source_system, external_id)) as source_name, count(*) as members
  from members group by entity_id"""
CTES["golden_norm"] = f"select entity_id, members, {normal()} from survived"
CTES["agreement"] = f"select r.entity_id, r.members, {gammas()} from members l join golden_norm r on l.entity_id = r.entity_id"
CTES["agreement_weight"] = f"select entity_id, members, {WEIGHT} as weight from agreement"
CTES["certainty"] = f"""select entity_id, case when any_value(members) = 1 then 1.0 else avg({CONFIDENCE}) end as confidence_score
  from agreement_weight group by entity_id"""
CTES["golden"] = """select entity_id, 'customer' as entity_type, first_name, last_name, email, phone, company_name,
  round(confidence_score, 6) as confidence_score, source_name, '2025-01-01' as created_at
  from survived join certainty using (entity_id)"""
CTES["crosswalk"] = "select source_system, external_id as source_id, entity_id from members"
CTES["per_system"] = "select entity_id, source_system, count(*) as records from crosswalk group by all"
CTES["coverage"] = """select entity_id, count(*) as source_count, array_to_string(list_sort(list(source_system)), ', ') as source_systems,
  cast(sum(records) as bigint) as total_source_records from per_system group by entity_id"""
CTES["c360"] = """select g.* exclude (entity_type, source_name, created_at), v.* exclude (entity_id)
  from golden g left join coverage v on v.entity_id = g.entity_id"""
RECORD_OF = """split_part('crm_contacts,billing_accounts,support_users,app_signups,partner_leads', ',', cast({0} % 5 + 1 as int)) as source_system,
  split_part('CRM,BILL,SUP,APP,PART', ',', cast({0} % 5 + 1 as int)) || '_' || lpad(cast({0} as varchar), 9, '0') as source_id"""
CTES["invoices"] = f"select {RECORD_OF.format('o_custkey')}, cast(round(o_totalprice * 100) as bigint) as amount_cents from orders"
CTES["app_events"] = f"select {RECORD_OF.format('user_id')}, event_id, event_type, value from events"

# Training: random pairs for u, counts per comparison vector, and the steps of expectation maximisation one by one.
NAMES = tuple(PARAMETERS)
GAMMAS = tuple(f"gamma_{a}" for a in NAMES)
SHARE = "least(1.0, 1000000 / (8.0 * total))"
CTES["numbered"] = """select p.*, cast('0x' || substr(md5(vid), 1, 12) as bigint) as place, (select count(*) from prof) as total from prof p"""
CTES["drawn"] = f"""select *, cast('0x' || substr(h, 1, 12) as bigint) % greatest(cast(floor(total * {SHARE}) as bigint) // 64, 1) as bucket
  from (select r.range as round, n.*, md5(cast(r.range as varchar) || ':' || vid) as h from numbered n, range(8) r
    where (place + r.range * {(1 << 48) // 8}) % {1 << 48} < cast(floor({SHARE} * {1 << 48}) as bigint))"""
CTES["neighbours"] = "select round, vid, lead(vid) over (partition by round, bucket order by h) as other from drawn"
CTES["neighbour_gammas"] = f"select {gammas()} from neighbours n join prof l on l.vid = n.vid join prof r on r.vid = n.other"
CTES["u_rows"] = " union all ".join(
    f"select '{a}' as field, (count(*) filter (where gamma_{a} = 1) + 1) / (count(*) filter (where gamma_{a} >= 0) + 2) as u, "
    f"count(*) filter (where gamma_{a} >= 0) as compared from neighbour_gammas" for a in NAMES)
CTES["patterns"] = f"""select {', '.join(GAMMAS)}, cast(sum(pairs) as double) as pairs from (
  select {', '.join(GAMMAS)}, n_left * n_right as pairs from compared
  union all select {', '.join(f'case when n_{a} is null then -1 else 1 end' for a in NAMES)}, n * (n - 1) / 2
  from prof where n > 1) group by all"""
STEPS = 25
_BOUND = "greatest(least({0}, 1 - 1e-6), 1e-6)"
_STATE = ", ".join([*[f"m_{a}, u_{a}" for a in NAMES], "rate", "done", "step"])
_U = {a: _BOUND.format(f"(select u from u_rows where field = '{a}')") for a in NAMES}
CTES["em_0"] = ("select " + ", ".join(f"greatest({PARAMETERS[a][1]}, {_U[a]}) as m_{a}, {_U[a]} as u_{a}" for a in NAMES)
                + ", 0.1 as rate, false as done, 0 as step")


def declared_start() -> str:
    """The first state with the declared u."""
    return ("select " + ", ".join(f"{PARAMETERS[a][1]} as m_{a}, {PARAMETERS[a][2]} as u_{a}" for a in NAMES)
            + ", 0.1 as rate, false as done, 0 as step")


def _likelihood(p: str) -> str:
    return " * ".join(f"case gamma_{a} when 1 then {p}_{a} when 0 then 1 - {p}_{a} else 1.0 end" for a in NAMES)


for _k in range(1, STEPS + 1):
    CTES[f"em_x{_k}"] = f"""select {_STATE}, {', '.join(GAMMAS)}, pairs, pairs * rate * {_likelihood('m')}
      / (rate * {_likelihood('m')} + (1 - rate) * {_likelihood('u')}) as expected from em_{_k - 1} cross join patterns"""
    CTES[f"em_y{_k}"] = f"select {_STATE}, {_BOUND.format('sum(expected) / sum(pairs)')} as new_rate, " + ", ".join(
        f"coalesce(greatest({_BOUND.format(f'coalesce(sum(expected) filter (where gamma_{a} = 1), 0) / sum(expected) filter (where gamma_{a} >= 0)')}, u_{a}), m_{a}) as new_{a}"
        for a in NAMES) + f" from em_x{_k} group by {_STATE}"
    CTES[f"em_{_k}"] = "select " + ", ".join(f"case when done then m_{a} else new_{a} end as m_{a}, u_{a}" for a in NAMES) + f""",
      case when done then rate else new_rate end as rate, case when done then step else {_k} end as step,
      done or greatest(abs(new_rate - rate), {', '.join(f'abs(new_{a} - m_{a})' for a in NAMES)}) < 0.001 as done from em_y{_k}"""
CTES["par"] = "select " + ", ".join(
    f"{w} * log2(m_{a} / u_{a}) as plus_{a}, {w} * log2((1 - m_{a}) / (1 - u_{a})) as minus_{a}" for a, (w, _, _) in PARAMETERS.items()
) + f" from em_{STEPS}"
MATERIALIZED = ("patterns", "u_rows", "par", "prof", "proft", f"em_{STEPS}")

_TRAINING = ("numbered", "drawn", "neighbours", "neighbour_gammas", "u_rows", "patterns", "par")
_GRAPH = [name for name in CTES if name not in ("nick", "invoices", "app_events", *_TRAINING) and not name.startswith("em_")]


def _variant(suffix: str, names: list[str], also: tuple[str, ...] = (), change=lambda body: body) -> None:
    """Add a group of CTEs again under names with a suffix, reading from each other and from `also` with the suffix."""
    for name in names:
        body = change(CTES[name])
        CTES[f"{name}{suffix}"] = re.sub(
            rf"\b(from|join) ({'|'.join(map(re.escape, [*also, *names]))})\b(?!\()",
            lambda m: f"{m.group(1)} {m.group(2)}{suffix}" + (f" {m.group(2)}" if _needs_alias(body, m) else ""), body)


def add_state(suffix: str, raw: str) -> None:
    """Add the whole chain again for another set of raw rows; all names get the suffix."""
    CTES[f"raw{suffix}"] = raw
    _variant(suffix, _GRAPH, ("raw",))


def add_trained(suffix: str = "t") -> None:
    """Add the chain from profiles to marts again with trained instead of declared parameters."""
    weight = " + ".join(f"case gamma_{a} when 1 then (select plus_{a} from par) when 0 then (select minus_{a} from par) else 0 end"
                        for a in PARAMETERS)
    own = " + ".join(f"case when n_{a} is not null then (select plus_{a} from par) else 0 end" for a in PARAMETERS)

    def change(body: str) -> str:
        return body.replace(WEIGHT, weight).replace(SELF_WEIGHT, own)

    _variant(suffix, _GRAPH[_GRAPH.index("normal"):], change=change)


def _needs_alias(body: str, match: re.Match) -> bool:
    """A table without an alias keeps its plain name for qualified columns."""
    following = body[match.end():].lstrip().split(" ", 1)[0].split("\n", 1)[0]
    return following in ("", "on", "where", "group", "join", "left", "using", "union", ")") or not following.isalpha()


def _uses(body: str) -> list[str]:
    return re.findall(r"\b(?:from|join) (\w+)", body)


def query(final: str, **extra: str) -> str:
    """`final` with all CTEs it needs; `extra` are CTEs of this query only."""
    known = {**CTES, **extra}
    order: list[str] = []

    def visit(name: str, path: tuple[str, ...] = ()) -> None:
        if name in order or name in path or name not in known:
            return
        for used in _uses(known[name]):
            visit(used, (*path, name))
        order.append(name)

    for name in _uses(final):
        visit(name)
    body = ",\n".join(f"{name} as {'materialized ' * (name in MATERIALIZED)}(\n{known[name]}\n)" for name in order)
    return f"with recursive {RAW_CTES.strip()}" + (f",\n{body}" if body else "") + f"\n{final}"
