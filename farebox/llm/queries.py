"""The numbered operators as queries over the driver tables, with SQL forms where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import (
    bpe, chat, decontaminate, licenses, merkle, neighbours, pii, secrets, simhash, spans, spelling, toxicity, urls, warc,
)
from farebox.session import pin_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def register(name: str, sql: str | None = None):
    def wrap(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(pin_settings(spark), sf_dir.rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_byte_level_bpe")
def op1(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.encode_texts(documents, RANK_FILE, PATTERN, with_ids=False).drop("text")


_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS_SQL = f"list_filter(string_split_regex({_LOWER_SQL}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"


@register("op2_benchmark_decontamination", f"""with d as (select doc_id, {_WORDS_SQL} as words from documents),
    b as (select item_id, {_WORDS_SQL} as words, least(len(words), 10) as k from benchmark),
    w as (select item_id, k, unnest(range(1, len(words) - k + 2)) as place, words from b where k > 0),
    grams as (select array_to_string(list_slice(words, place, place + k - 1), ' ') as gram, k, list(distinct item_id) as items from w group by 1, 2),
    lengths as (select distinct k from grams),
    places as (select doc_id, k, unnest(range(1, len(words) - k + 2)) as place, words from d, lengths where len(words) >= k),
    hits as (select p.doc_id, p.place, p.k, g.items from places p join grams g
      on g.k = p.k and g.gram = array_to_string(list_slice(p.words, p.place, p.place + p.k - 1), ' ')),
    words_hit as (select doc_id, count(distinct position) as n_hit
      from (select doc_id, unnest(range(place, place + k)) as position from hits) group by 1),
    items_hit as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items
      from (select doc_id, cast(unnest(items) as varchar) as item from hits) group by 1)
    select d.doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
      sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from d left join words_hit using (doc_id) left join items_hit using (doc_id)""")
def op2(spark, sf):
    found = decontaminate.find_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), window=10)
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


RULES = (
    urls.Rule("allow", "org"), urls.Rule("block", "example.org", "/es/"), urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"), urls.Rule("block", "com", "/de/"),
)


def _urls_sql() -> str:
    """The URL filter said in SQL, over the same rules and vocabulary."""
    rules = ", ".join(f"('{r.action}', '{r.host}', '{r.path}')" for r in RULES)
    def sum_of(terms) -> str:
        # a pattern per term, so that each is compiled once
        edges = "(^|[^\\p{L}\\p{N}])", "([^\\p{L}\\p{N}]|$)"
        return " + ".join(f"{w} * cast(regexp_matches(lower, '{edges[0]}{t}{edges[1]}') as int)" for t, w in terms)

    strict = sum_of((t, 1) for t in urls.STRICT_TERMS)
    soft = sum_of((t, 1) for t in urls.SOFT_TERMS)
    weight = sum_of((t, f"cast({w} as double)") for t, w in urls.SOFT_TERMS.items())
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""with rules as (select * from (values {rules}) t(action, host, start)),
    cut as (select page_id, coalesce(url, '') as url, case when contains(url, '://')
      then split_part(split_part(substr(url, strpos(url, '://') + 3), '#', 1), '?', 1) else '' end as rest from pages),
    parts as (select page_id, {lower.format("url")} as lower, split_part(rest, '/', 1) as h, rest from cut),
    hosts as (select page_id, lower, {lower.format("h")} as host, substr(rest, length(h) + 1) as path from parts),
    judged as (select page_id, host, path, cast({strict} as int) as n_strict, cast({soft} as int) as n_soft,
      {weight} as soft_weight from hosts),
    fitting as (select page_id, r.action, r.host || r.start as name, row_number() over (
        partition by page_id order by length(r.host || r.start) desc, length(r.host) desc) as nth
      from judged j join rules r on (j.host = r.host or ends_with(j.host, '.' || r.host)) and starts_with(j.path, r.start))
    select j.page_id, host, path, f.name as rule, n_strict, n_soft, soft_weight, coalesce(f.action,
      case when n_strict >= 1 or n_soft >= {urls.LEAST_SOFT_TERMS} and soft_weight >= {urls.SOFT_LIMIT} then 'block' else 'allow' end) as verdict
    from judged j left join fitting f on f.page_id = j.page_id and f.nth = 1"""


@register("op3_url_filter", _urls_sql())
def op3(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return urls.judge_urls(pages, RULES).drop("url")


@register("op4_toxicity")
def op4(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    scored = toxicity.score_texts(documents, toxicity.fit(documents, table(spark, sf, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@register("op5_personal_data")
def op5(spark, sf):
    found = pii.find_personal_data(table(spark, sf, "documents").select("doc_id", "text"))
    s = F.col("pii_spans")
    return found.select(
        "doc_id", *[spans.of_kind(s, k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(spans.joined(spans.base_only(s)), 256).alias("base_sha256"), spans.joined(s).alias("spans"))


def _matches_sql(name: str, pattern: str, holds: str) -> str:
    """CTE ``name``: ``doc_id``, ``start``, ``stop`` of the matches of a pattern, from left to right without overlaps, that
    ``holds``; where they begin comes from the lengths of what lies before."""
    whole = f"(?s)(.*?)({pattern})"
    return f"""{name}_lists as (select doc_id, regexp_extract_all(text, '{whole}', 1) as gaps, regexp_extract_all(text, '{whole}', 2) as hits
        from documents),
      {name}_all as (select doc_id, unnest(gaps) as before, unnest(hits) as found, unnest(range(len(hits))) as nth from {name}_lists),
      {name}_at as (select doc_id, found, sum(length(before) + length(found)) over (partition by doc_id order by nth) as stop from {name}_all),
      {name} as (select doc_id, cast(stop - length(found) as bigint) as start, cast(stop as bigint) as stop from {name}_at where {holds})"""


_DIGITS = "regexp_replace(found, '[^0-9]', '', 'g')"
_LUHN = (f"list_sum(list_transform(range(length({_DIGITS})), lambda i: cast(substr({_DIGITS}, length({_DIGITS}) - i, 1) as int) * (1 + i % 2)"
         f" - 9 * cast(cast(substr({_DIGITS}, length({_DIGITS}) - i, 1) as int) * (1 + i % 2) > 9 as int))) % 10 = 0")
_BASE_OF_PII = {
    "email": ("[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+", "true"),
    "ip": ("[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)",
           "len(list_filter(string_split(found, '.'), lambda x: length(ltrim(x, '0')) > 3 or cast('0' || ltrim(x, '0') as bigint) > 255)) = 0"),
    "card": ("[0-9]([ -]?[0-9])+", f"length({_DIGITS}) between 13 and 19 and {_LUHN}"),
    "phone": ("\\+[0-9][ ().0-9-]+[0-9]", f"length({_DIGITS}) between 9 and 15"),
}
_KEYWORD = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_AFTER_KEYWORD = "[\"\'\']? *[:=] *[\"\'\']?"
_BASE_OF_SECRETS = {
    "assign": (f"({_KEYWORD}){_AFTER_KEYWORD}([A-Za-z0-9+/_.=-]+)",
               f"length(regexp_extract(found, '({_KEYWORD}){_AFTER_KEYWORD}([A-Za-z0-9+/_.=-]+)', 2)) >= 8"),
    "access": ("AKIA[A-Z0-9]+", "length(found) >= 16"),
    "hex": ("[0-9a-f]+", "length(found) >= 32"),
}


def _base_spans_sql(kinds: dict[str, tuple[str, str]], order: str) -> str:
    found = ", ".join(_matches_sql(kind, *how) for kind, how in kinds.items())
    spans_ = " union all ".join(f"select doc_id, '{kind}' as kind, {i} as nth, start, stop from {kind}" for i, kind in enumerate(kinds))
    counts = ", ".join(f"count(*) filter (kind = '{kind}') as n_{kind}" for kind in kinds)
    return f"""with {found}, spans as ({spans_}),
      joined as (select doc_id, {counts}, string_agg(kind || ':' || start || ':' || stop, ',' order by {order}) as base from spans group by 1)
    select doc_id, {", ".join(f"coalesce(n_{kind}, 0) as n_{kind}" for kind in kinds)}, sha256(coalesce(base, '')) as base_sha256
    from documents left join joined using (doc_id)"""


@register("base_spans_of_personal_data", _base_spans_sql(_BASE_OF_PII, "nth, start"))
def pii_base(spark, sf):
    """What SQL can say of op5."""
    return op5(spark, sf).drop("spans")


@register("base_spans_of_secrets", _base_spans_sql(_BASE_OF_SECRETS, "start, nth"))
def secrets_base(spark, sf):
    """What SQL can say of op8."""
    return op8(spark, sf).drop("spans")


@register("op6_nearest_neighbours")
def op6(spark, sf):
    return neighbours.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@register("op7_simhash_near_duplicates")
def op7(spark, sf):
    parts = simhash.near_duplicate_components(table(spark, sf, "documents"))
    return parts.select("doc_id", F.lower(F.lpad(F.hex("fingerprint_bits"), 16, "0")).alias("fingerprint"), "component_id")


@register("op8_secret_scan")
def op8(spark, sf):
    found = secrets.find_secrets(table(spark, sf, "documents").select("doc_id", "text"))
    s = F.col("secret_spans")
    return found.select(
        "doc_id", *[spans.of_kind(s, k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(spans.joined(spans.base_only(s)), 256).alias("base_sha256"), spans.joined(s).alias("spans"))


@register("op9_chat_windows")
def op9(spark, sf):
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    conversations = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    windows = chat.format_conversations(conversations, RANK_FILE, PATTERN)
    return chat.read_conversations(windows).drop("n_windows")


@register("turns_read_back_from_chat", """with turns as (
      select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
      union all select -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
    summed as (select conv_id, count(*) as n_turns,
        string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
        coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as said from turns group by 1)
    select conv_id, n_turns, sha256(turns) as turns_sha256, length(said) as loss_chars, sha256(said) as loss_sha256 from summed""")
def chat_turns(spark, sf):
    """What SQL can say of op9: all but the length of the formatted text."""
    return op9(spark, sf).drop("formatted_chars")


@register("op10_warc", """with p as (select page_id, coalesce(html, '') as html from pages),
    h as (select page_id, strlen(html) as n, sha256(html) as digest from p),
    f as (select digest, min(page_id) as first from h group by 1)
    select page_id, n as payload_bytes, h.digest as payload_digest,
      case when n >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
      case when n >= 100 and page_id <> first then first end as refers_to
    from h join f using (digest)""")
def op10(spark, sf):
    archives = warc.archive_pages(table(spark, sf, "pages"))
    records = warc.read_archives(archives)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# CRC-32 of a text in SQL: the table from its rule (the reversed polynomial), then a step per byte
_CRC_TABLE_SQL = """crc as (select list(list_reduce(list_prepend(i, range(8)),
    lambda c, step: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by i) as codes
    from (select unnest(range(256)) as i))"""


def _crc_sql(text: str) -> str:
    hexed = f"hex(encode({text}))"
    octets = f"list_transform(range(octet_length(encode({text}))), lambda b: cast('0x' || substr({hexed}, 2 * b + 1, 2) as bigint))"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, {octets}), "
            "lambda c, octet: xor(c >> 8, codes[(xor(c, octet) & 255) + 1])))")


# What the contract lets happen to a run of letters: where this number divides its checksum, a letter is lost.
LOSE_EVERY = 31
LEAST_LETTERS, LEAST_OCCURRENCES = 7, 2


@register("op11_spelling_variants", f"""with recursive {_CRC_TABLE_SQL},
    runs as (select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]{{7,}}')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents),
    summed as (select run, {_crc_sql("coalesce(cast(doc_id as varchar), '') || ':' || run")} as h from runs, crc),
    lost as (select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from summed),
    words as (select word, count(*) as n from lost where length(word) >= 7 group by 1 having count(*) >= 2),
    gaps as (select word, n, unnest(range(length(word))) as i from words),
    cut as (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as rest, substr(word, 1, i) || ' ' || substr(word, i + 2) as gapped from gaps),
    pairs as (select a.word, b.word as other, b.n as other_n from cut a join cut b on a.gapped = b.gapped and a.word <> b.word
      union select c.word, w.word, w.n from cut c join words w on c.rest = w.word
      union select w.word, c.word, c.n from cut c join words w on c.rest = w.word),
    near as (select word, count(*) as n_near, max(other_n) as most from pairs group by 1),
    best as (select p.word, min(p.other) as other, any_value(p.other_n) as other_n, any_value(n_near) as n_near
      from pairs p join near using (word) where p.other_n = most group by 1),
    formed as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when other_n >= 10 * w.n then other end as form,
      case when other_n >= 10 * w.n then other_n end as form_n from words w left join best b using (word)),
    steps as (select word, word as root from formed
      union all select s.word, f.form from steps s join formed f on f.word = s.root where f.form is not null),
    ends as (select s.word, s.root from steps s join formed f on f.word = s.root where f.form is null)
    select word, form, root, n, n_near, form_n from formed join ends using (word)""")
def op11(spark, sf):
    documents = table(spark, sf, "documents")
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(spelling.word_runs(F.col("text"), LEAST_LETTERS)).alias("run"))
    summed = runs.select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"))
    gone = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.left("run", gone), F.substr("run", gone + 2))
    words = summed.select(F.when(F.col("h") % LOSE_EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.char_length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n"))
    return spelling.variant_groups(counted.where(F.col("n") >= LEAST_OCCURRENCES))


def _leaf_sql(text: str) -> str:
    values = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(
        f"coalesce(octet_length(encode(cast({v} as varchar))) || ':' || cast({v} as varchar), '-')" for v in values) + ")"


@register("op12_merkle_manifest", f"""with recursive {_CRC_TABLE_SQL},
    docs as (select doc_id, source, {_leaf_sql("text")} as leaf, {_leaf_sql("replace(text, chr(10), '')")} as tampered,
      {_crc_sql("cast(doc_id as varchar)")} % 2 = 0 as hit from documents, crc),
    leaves as (select *, row_number() over (partition by source order by doc_id) - 1 as place,
      count(*) over (partition by source) as n from docs),
    nodes as (select source, 0 as level, place, leaf as digest, n from leaves
      union all select source, level + 1, place // 3, sha256(string_agg(digest, '' order by place)), (n + 2) // 3
      from nodes where n > 1 group by source, level, place // 3, n),
    subroots as (select source, digest as subroot, row_number() over (order by source nulls first) - 1 as place, count(*) over () as n
      from nodes where n = 1),
    tops as (select 0 as level, place, subroot as digest, n from subroots
      union all select level + 1, place // 3, sha256(string_agg(digest, '' order by place)), (n + 2) // 3
      from tops where n > 1 group by level, place // 3, n),
    ways as (select l.doc_id, 0 as upper, d.level,
        coalesce(string_agg(d.digest, '' order by d.place) filter (d.place < l.place // cast(pow(3, d.level) as bigint)), '') as l,
        coalesce(string_agg(d.digest, '' order by d.place) filter (d.place > l.place // cast(pow(3, d.level) as bigint)), '') as r
      from leaves l join nodes d on l.source is not distinct from d.source and d.n > 1
        and d.place // 3 = l.place // cast(pow(3, d.level + 1) as bigint) group by all
      union all select l.doc_id, 1, d.level,
        coalesce(string_agg(d.digest, '' order by d.place) filter (d.place < s.place // cast(pow(3, d.level) as bigint)), ''),
        coalesce(string_agg(d.digest, '' order by d.place) filter (d.place > s.place // cast(pow(3, d.level) as bigint)), '')
      from leaves l join subroots s on l.source is not distinct from s.source
        join tops d on d.n > 1 and d.place // 3 = s.place // cast(pow(3, d.level + 1) as bigint) group by all),
    numbered as (select *, row_number() over (partition by doc_id order by upper, level) as step from ways),
    proofs as (select doc_id, string_agg(l || r, '' order by step) as proof, max(step) as steps from numbered group by 1),
    folded as (select doc_id, 0 as step, case when hit then tampered else leaf end as digest from leaves
      union all select f.doc_id, w.step, sha256(w.l || f.digest || w.r) from folded f join numbered w on w.doc_id = f.doc_id and w.step = f.step + 1)
    select d.doc_id, d.leaf, s.subroot, t.digest as root, sha256(coalesce(p.proof, '')) as proof_sha256, f.digest as folded_root,
      f.digest = t.digest as verified
    from docs d join subroots s on d.source is not distinct from s.source join tops t on t.n = 1
      left join proofs p on p.doc_id = d.doc_id join folded f on f.doc_id = d.doc_id and f.step = coalesce(p.steps, 0)""")
def op12(spark, sf):
    documents = table(spark, sf, "documents")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = F.when(hit, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    manifest = merkle.build(documents, [*values, F.col("text")], F.col("doc_id"), F.col("source"), [*values, tampered])
    return merkle.prove(manifest, whole=False).withColumnsRenamed({"key": "doc_id", "proof": "proof_sha256"})


def _licenses_sql() -> str:
    """The scan said in SQL, over the same templates."""

    def rows(values):
        return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in values)

    index = licenses.INDEX
    templates = rows((i, t.label, int(t.is_name), 0 if t.is_name else licenses.SLACK, len(t.postings)) for i, t in enumerate(index))
    postings = rows((i, p, w) for i, t in enumerate(index) for p, w in t.postings)
    keys = rows((i, p, " ".join(k), len(k)) for i, t in enumerate(index) for p, k in t.keys)
    return f"""with templates as (select * from (values {templates}) t(of, label, is_name, slack, n_postings)),
    postings as (select * from (values {postings}) t(of, place, word)),
    key_phrases as (select * from (values {keys}) t(of, place, phrase, n)),
    d as (select doc_id, {_WORDS_SQL} as words, row_number() over () as r from documents),
    w as (select r, unnest(words) as word, unnest(range(len(words))) as i from d),
    looked_up as (select distinct r, of, i - place as start from w join postings using (word)),
    candidates as (select c.r, c.of, c.start, label, is_name, slack, n_postings, words
      from looked_up c join templates using (of) join d using (r)),
    shares as (select r, of, start, label, is_name, count(*) filter (list_contains(
        words[greatest(start + p.place - slack, 0) + 1 : start + p.place + slack + 1], p.word)) / any_value(n_postings) as share
      from candidates join postings p using (of) group by r, of, start, label, is_name),
    verified as (select r, of, start, bool_and(contains(
        ' ' || array_to_string(words[greatest(start + k.place - slack, 0) + 1 : start + k.place + slack + k.n], ' ') || ' ',
        ' ' || k.phrase || ' ')) as ok
      from candidates join key_phrases k using (of) group by r, of, start),
    good as (select r, label, is_name, start, share from shares join verified using (r, of, start) where ok and share >= {licenses.ENOUGH}),
    judged as (select r, count(*) filter (is_name = 1) as n_base, min(start) filter (is_name = 1) as first_word,
        max(start) filter (is_name = 1) as last_word, string_agg(distinct label, ',' order by label) filter (is_name = 1) as base_labels,
        string_agg(distinct label, ',' order by label) as labels,
        max(case when is_name = 1 then 0.5 else 0.5 + 0.5 * share end) as score from good group by r)
    select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
      coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, cast(coalesce(score, 0) as double) as score
    from d left join judged using (r)"""


@register("op13_license_scan", _licenses_sql())
def op13(spark, sf):
    found = licenses.scan_licenses(table(spark, sf, "documents").select("doc_id", "text"))
    names, terms = F.col("name_places"), F.col("license_terms")
    labels = F.concat(F.transform(names, lambda x: x["label"]), F.transform(terms, lambda x: x["label"]))

    def listed(values):
        return F.array_join(F.array_sort(F.array_distinct(values)), ",")

    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.size(names).cast("long").alias("n_base"),
        F.array_min(F.transform(names, lambda x: x["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform(names, lambda x: x["start"])).cast("long").alias("last_word"),
        listed(F.transform(names, lambda x: x["label"])).alias("base_labels"), listed(labels).alias("labels"),
        F.col("license_score").alias("score"))


@register("pipeline")
def pipeline(spark, sf):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)
