"""The catalogue's queries once more, as SQL for DuckDB over the same tables."""

from __future__ import annotations

import re

from quillmark.functions import fixed_values as V
from quillmark.functions.text import WHITESPACE
from quillmark.plans.catalogue import SEED_CATEGORY, SHARD_ROWS, SYSTEM_TEXT
from quillmark.plans.fixtures import NO_INFORMATION

_CLASS = "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE)


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {lit(WHITESPACE)})"


def collapse(x: str) -> str:
    return f"regexp_replace({strip(x)}, '[{_CLASS}]+', ' ', 'g')"


def clean(x: str) -> str:
    return f"regexp_replace({collapse(x)}, '\\{{.*?\\}}|\\}}', '', 'g')"


def tag(x: str, name: str) -> str:
    pattern = f"'(?is)<{name}>(.*?)</{name}>'"
    return f"(case when regexp_matches({x}, {pattern}) then {strip(f'regexp_extract({x}, {pattern}, 1)')} end)"


def fill(template: str, **values: str) -> str:
    pieces = re.split("(" + "|".join("{%s}" % n for n in values).replace("{", r"\{").replace("}", r"\}") + ")", template)
    shown = [values[p[1:-1]] if p[1:-1] in values and p.startswith("{") else lit(p) for p in pieces if p]
    return "(" + " || ".join(shown) + ")"


def turn(role: str, content: str) -> str:
    return f"('<start_of_turn>{role}' || chr(10) || {content} || '<end_of_turn>' || chr(10))"


OPEN = "'<start_of_turn>model' || chr(10)"

QA_RESULTS = """
qa as (select u.conv_id*100+u.turn as id, u.text as question, a.text as generated_answer,
  case when u.conv_id%4=0 then a.text when u.conv_id%2=0 then substring(a.text,5,12) else u.text end as expected_answer,
  case u.conv_id%3 when 0 then 'Easy' when 1 then 'Medium' else 'Hard' end as difficulty,
  case (u.conv_id*100+u.turn)%5 when 0 then 'Yes' when 1 then 'Yes, but' when 2 then 'No'
    when 3 then ' yes indeed' else '' end as judge_reply
from conversations u join conversations a on a.conv_id=u.conv_id and a.turn=u.turn+1
where u.role='user' and a.role='assistant')"""

LABELLED = """
labelled as (select d.doc_id, d.text, case when l.toxic=1 then 'negative' when l.quality=1 then 'positive'
  else 'neutral' end as sentiment_true from documents d left join labels l on l.doc_id=d.doc_id)"""

PREDICTIONS = LABELLED + """,
predictions as (select t.*, case doc_id%7
  when 0 then concat('<sentiment>',sentiment_true,'</sentiment> <reasoning>',text,'</reasoning>')
  when 1 then '<SENTIMENT> Positive </SENTIMENT>' when 2 then '<sentiment>negative'
  when 3 then '<sentiment></sentiment> neutral'   when 4 then 'no idea'
  when 5 then concat('<sentiment>',sentiment_true,'</sentiment><reasoning>None</reasoning>')
  else '<sentiment>not positive</sentiment><reasoning></reasoning>' end as raw_output,
  case doc_id%6 when 0 then '8' when 1 then '10' when 2 then '7/10' when 3 then 'Score: 9'
    when 4 then 'great' else '11' end as judge_reply from labelled t)"""

PARSED = PREDICTIONS + f""",
tagged as (select *, {tag('raw_output', 'sentiment')} as s, {tag('raw_output', 'reasoning')} as r from predictions),
sourced as (select *, lower(case when s is null or s='' then raw_output else s end) as source from tagged),
parsed as (select *, case when contains(source,'positive') then 'positive' when contains(source,'negative') then 'negative'
    when contains(source,'neutral') then 'neutral' else 'none' end as sentiment_pred,
  coalesce(nullif(r,''),'none') as reasoning_pred, coalesce(nullif(r,''),raw_output) as reasoning_or_raw,
  s is not null as sentiment_tag_present, r is not null as reasoning_tag_present from sourced)"""

TURNS = """
turns as (select conv_id, turn, role, case when (conv_id*7+turn)%23=0
  then concat(text,' Not specified.') else text end as content from conversations)"""

STOPPED = "(" + " or ".join(f"contains(lower(content), '{p}')" for p in V.STOP_PHRASES) + ")"

USEFUL = TURNS + f""",
verdicts as (select conv_id, count(*) as n_turns, not bool_or({STOPPED}) as useful from turns group by conv_id)"""


def ranked(source: str, row_id: str, seed: int, name: str = "ranked") -> str:
    return f"""{name} as (select *, row_number() over (order by md5('{seed}|' || {row_id}::varchar)) as rank,
  count(*) over () as n from {source})"""


SPLIT = USEFUL + ",\n" + ranked("verdicts", "conv_id", 0) + """,
splits as (select *, case when rank <= n - floor(n*0.1::double) then 'train' else 'eval' end as split from ranked)"""

VECTORS = """
vectors as (select a.vec_id, a.label, a.embedding::double[] as e, b.embedding::double[] as o, (a.vec_id%11)/10.0::double as w
  from embeddings a join embeddings b on b.vec_id=a.vec_id+1),
pairs as (select vec_id, label, round(list_cosine_similarity(e,
  list_transform(range(1,len(e)+1), lambda i: w*e[i]+(1-w)*o[i])), 6) as similarity from vectors)"""

TOKENS = """
tokens as (select vec_id, label, list_transform(embedding, lambda x: -abs(x::double)*10) as logprobs,
  list_transform(embedding, lambda x: floor(x::double*10000)::int) as tokens, vec_id%8 as prompt_length from embeddings)"""

PAGES = f"""
cut as (select page_id, {tag('html', 'title')} as title, string_split(html, '<p>') as pieces from pages),
allowed as (select * from cut where not contains(pieces[1], 'track(1')),
raw as (select page_id, title, unnest(pieces) as raw, generate_subscripts(pieces, 1)-1 as piece from allowed),
records as (select page_id, piece, title || ' : ' || {clean('raw')} as text from raw where length(raw) > length(title))"""


def chunks(source: str, keep: str) -> str:
    return f"""numbered as (select {keep}, text,
  unnest(range(0, greatest(ceil((length(text)-64)/958.0), 1)::bigint)) as chunk_no from {source}),
chunks as (select {keep}, chunk_no::int as chunk_no, substring(text, chunk_no*958+1, 1022) as chunk from numbered)"""


def _pair_sql(keep: str) -> str:
    """Pairs and ratings as the stand-in models give them."""
    return f"""sized as (select *, greatest(1, ceil(length(chunk)/25.0))::bigint as size, md5(chunk) < '2' as refused from chunks),
pieces as (select {keep}, chunk_no, i, substring(chunk, i*size+1, size) as piece
  from (select *, unnest(range(25)) as i from sized where not refused)),
pairs as (select {keep}, chunk_no, i::int as pair_no, i || ': ' || piece || '?' as question,
  case when i%2=1 then array_to_string(list_transform(range(0, length(piece), 2), lambda j: substring(piece, j+1, 1)), '')
    else 'Not specified' end as answer from pieces where piece <> ''),
moods as (select *, substring(md5(first_value(question) over (partition by {keep}, chunk_no, pair_no//4 order by pair_no)),2,1) as mood from pairs),
scored as (select *, case when mood='0' or (mood='1' and pair_no%4=0) then null
  else ((instr('0123456789abcdef', substring(md5(question),1,1))-1)%10+1)::double end as rating from moods)"""


def _cut_pair_sql(keep: str) -> str:
    """Pairs of replies that end within a pair, and their ratings, as the moody stand-ins give them."""
    return f"""sized as (select *, greatest(1, ceil(length(chunk)/25.0))::bigint as size, md5(chunk) as h from chunks),
counted as (select *, ceil(length(chunk)/size::double)::bigint as n from sized),
replies as (select *, case when h >= '2' and h < 'f' then ('0x' || substring(h,2,2))::int % (n+1) end as whole from counted),
pieces as (select {keep}, chunk_no, i, substring(chunk, i*size+1, size) as piece
  from (select *, unnest(range(whole)) as i from replies where whole is not null)),
pairs as (select {keep}, chunk_no, i::int as pair_no, i || ': ' || piece || '?' as question from pieces),
moods as (select *, substring(md5(first_value(question) over (partition by {keep}, chunk_no, pair_no//4 order by pair_no)),2,1) as mood from pairs),
scored as (select *, case when mood in ('0','3') or (mood='1' and pair_no%4=0) then null
  else ((instr('0123456789abcdef', substring(md5(question),1,1))-1)%10+1)::double end as rating from moods)"""


EDGES = """
edges as (select concat('Category:R',r_regionkey) as category, concat('Category:N',n_nationkey) as member
  from region join nation on n_regionkey=r_regionkey
union all select concat('Category:N',n_nationkey), concat('Category:R',n_regionkey) from nation
union all select concat('Category:N',s_nationkey), concat('S',s_suppkey) from supplier
union all select concat('Category:N',c_nationkey), case when c_custkey%10=0 then concat('Category:C',c_custkey) else concat('C',c_custkey) end from customer
union all select concat('Category:C',o_custkey), concat('O',o_orderkey) from orders)"""

LOGS = """
logs as (select event_id as step, event_id/1000.0::double as epoch,
  case when event_type in ('click','view') then value end as loss,
  case when event_type='error' then value end as eval_loss from events)"""

KEYWORD = "contains(lower(generated_answer), lower(expected_answer))"


def verdict(reply: str) -> str:
    return f"(lower(regexp_extract({strip(reply)}, '^[^{_CLASS}]+')) = 'yes')"


LETTERS = "['a','e','i','o','n','r','s','t']"


def letters(x: str) -> str:
    return f"list_transform({LETTERS}, lambda c: (length({x})-length(replace({x}, c, '')))::double)"


def letter_similarity(a: str, b: str) -> str:
    """Null where a text has none of the letters."""
    some = f"list_sum({letters(a)}) > 0 and list_sum({letters(b)}) > 0"
    return f"(case when {some} then list_cosine_similarity({letters(a)}, {letters(b)}) end)"


def word_perplexity(x: str) -> str:
    words = f"list_transform(string_split({x}, ' '), lambda w: length(w)/10.0::double)"
    return f"exp(list_sum({words}) / len(string_split({x}, ' ')))"


def token_perplexity(x: str) -> str:
    """Two tokens a word, at a tenth and a fifth of its length."""
    words = f"list_transform(string_split({x}, ' '), lambda w: length(w)*0.3::double)"
    return f"exp(list_sum({words}) / (2*len(string_split({x}, ' '))))"


def parrot(said: str) -> str:
    """The stand-in's answer to a user turn that is already stripped."""
    half = strip(f"substring({said}, (length({said})//2)::bigint+1)")
    return f"(case when md5({said}) < '8' then {said} else {half} end)"


def grouped(source: str, group: str, metrics: dict[str, str]) -> str:
    shown = ", ".join(f"round({m}, 6) as {name}" for name, m in metrics.items())
    return f"""select case when grouping({group})=1 then 'all' else {group}::varchar end as {group}, grouping({group})=1 as is_total, count(*) as n, {shown}
from {source} group by grouping sets (({group}), ())"""


def share(flag: str) -> str:
    return f"avg(({flag})::int)"


QUESTION_TURN = turn("user", f"question || {lit(V.ANSWER_INSTRUCTION)}")
BASE_PROMPT = f"({QUESTION_TURN} || {OPEN})"
TUNED_PROMPT = f"({turn('system', lit(SYSTEM_TEXT))} || {QUESTION_TURN} || {OPEN})"


def judge_prompt(generated: str) -> str:
    body = fill(V.JUDGE_TEMPLATE, question="question", expected="expected_answer", generated=generated)
    return f"({turn('system', lit(V.JUDGE_SYSTEM_TEXT))} || {turn('user', body)} || {OPEN})"


def coin(prompt: str) -> str:
    return f"(case when md5({prompt}) < '8' then 'Yes' else 'No, not quite' end)"


def classify_body(x: str) -> str:
    return fill(V.CLASSIFY_INSTRUCTION + V.HEADLINE_TEMPLATE, text=x)


def explain_prompt(sentence: str, name: str) -> str:
    body = fill(V.EXPLAIN_TEMPLATE, sentence=sentence, sentiment=name)
    return f"({turn('system', lit(V.EXPLAIN_SYSTEM_TEXT))} || {turn('user', body)} || {OPEN})"


def reasoning_prompt(sentence: str, name: str, reasoning: str) -> str:
    body = fill(V.REASONING_JUDGE_TEMPLATE, sentence=sentence, sentiment=name, reasoning=reasoning)
    return f"({turn('user', body)} || {OPEN})"


SCORE = r"try_cast(nullif(regexp_extract(judge_reply, '\b([1-9]|10)\b', 1), '') as int)"

REPORT = """
classes as (select unnest(['negative','neutral','positive','none']) as label),
per_class as (select label, (select count(*) from parsed where sentiment_true=label and sentiment_pred=label) as tp,
  (select count(*) from parsed where sentiment_pred=label) as predicted,
  (select count(*) from parsed where sentiment_true=label) as support from classes),
scored as (select label, support, tp, coalesce(tp/nullif(predicted,0)::double, 0) as precision,
  coalesce(tp/nullif(support,0)::double, 0) as recall, coalesce(2*tp/nullif(predicted+support,0)::double, 0) as f1 from per_class),
report as (select label, precision, recall, f1, support from scored
union all select 'accuracy', sum(tp)/sum(support)::double, sum(tp)/sum(support)::double, sum(tp)/sum(support)::double, sum(support) from scored
union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from scored
union all select 'weighted avg', sum(precision*support)/sum(support), sum(recall*support)/sum(support), sum(f1*support)/sum(support), sum(support) from scored)"""

INTEGRITY = """select count(*) as n, round(avg(sentiment_tag_present::int),6) as sentiment_rate,
  round(avg(reasoning_tag_present::int),6) as reasoning_rate,
  round(avg((sentiment_tag_present and reasoning_tag_present)::int),6) as both_rate from parsed"""


def all_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["keyword_accuracy_by_difficulty"] = f"with {QA_RESULTS} " + grouped(
        "qa", "difficulty", {"keyword_accuracy": share(KEYWORD)}
    )
    lenient = r"regexp_matches(judge_reply, '^\s*(?i:yes)[[:punct:]]*(\s|$)')"
    sql["judge_accuracy_by_difficulty"] = f"with {QA_RESULTS} " + grouped(
        "qa",
        "difficulty",
        {
            "judge_accuracy": share(verdict("judge_reply")),
            "judge_accuracy_lenient": share(lenient),
            "score": share(verdict("judge_reply")),
        },
    )
    full = {
        "keyword_accuracy": share("k"),
        "semantic_accuracy": share("coalesce(s >= 0.7, false)"),
        "judge_accuracy": share("j"),
        "mean_perplexity": "avg(p)",
        "score": share("j"),
    }
    measured = f"""m as (select difficulty, {KEYWORD} as k, {verdict('judge_reply')} as j, {word_perplexity('expected_answer')} as p,
  {letter_similarity('expected_answer', 'generated_answer')} as s from qa)"""
    sql["eval_full_report"] = f"with {QA_RESULTS}, {measured} " + grouped("m", "difficulty", full)
    turned = """tuned as (select id, difficulty, expected_answer, generated_answer || ' ' || question as generated_answer,
  case when length(question) > 150 then 'Yes' else judge_reply end as judge_reply from qa),
apart as (select * from tuned where id%7 <> 0 union all select * replace (id+1000000000 as id) from tuned where id%9 = 0)"""
    met = f"""met as (select coalesce(b.difficulty, t.difficulty) as difficulty, b.id is not null and t.id is not null as m,
  b.id is not null and t.id is null as bo, t.id is not null and b.id is null as tu, b.k as bk, b.j as bj, t.k as tk, t.j as tj
from (select id, difficulty, ({KEYWORD})::int as k, {verdict('judge_reply')}::int as j from qa) b
full join (select id, difficulty, ({KEYWORD})::int as k, {verdict('judge_reply')}::int as j from apart) t on b.id=t.id)"""
    means = {f"{m}_{x}": f"round(avg({x[0]}{m[0]}) filter (where m), 6)" for m in ("keyword", "judge") for x in ("base", "tuned")}
    shown = ", ".join(f"{v} as {k}" for k, v in means.items())
    gaps = ", ".join(f"round({m}_tuned-{m}_base, 6) as {m}_delta" for m in ("keyword", "judge"))
    sql["model_comparison"] = f"""with {QA_RESULTS}, {turned}, {met},
r as (select case when grouping(difficulty)=1 then 'all' else difficulty end as difficulty, grouping(difficulty)=1 as is_total,
  count(*) filter (where m) as n_matched, count(*) filter (where bo) as n_base_only, count(*) filter (where tu) as n_tuned_only, {shown}
from met group by grouping sets ((difficulty), ()))
select *, {gaps} from r"""

    sql["semantic_similarity"] = f"with {VECTORS} select vec_id, similarity from pairs"
    sql["semantic_accuracy_threshold"] = f"""with {VECTORS}
select threshold, count(*) as n, count(*) filter (where similarity >= threshold) as n_correct,
  round(avg((similarity >= threshold)::int), 6) as accuracy
from pairs, (select unnest([0.0, 0.5, 0.7])::double as threshold) group by threshold"""
    tail = "list_slice(logprobs, prompt_length+1, len(logprobs))"
    sql["perplexity_by_group"] = f"with {TOKENS} " + grouped(
        "tokens", "label", {"mean_perplexity": f"avg(exp(-list_sum({tail})/len({tail})))"}
    )
    kept = "list_slice(tokens, prompt_length+1, len(tokens))"
    sql["new_tokens"] = f"with {TOKENS} select vec_id, len({kept})::int as n_kept, array_to_string({kept}, ',') as kept from tokens"
    sql["token_budget"] = f"with {TOKENS} select vec_id, least(len(tokens), 16)::int as n_kept, array_to_string(list_slice(tokens, 1, 16), ',') as kept from tokens"
    sql["judge_prompts"] = f"""with {QA_RESULTS} select id, md5({judge_prompt('generated_answer')}) as judge_md5,
  md5({BASE_PROMPT}) as base_md5, md5({TUNED_PROMPT}) as tuned_md5 from qa"""
    answer = strip(parrot(strip(f"question || {lit(V.ANSWER_INSTRUCTION)}")))
    sql["generate_answers"] = f"""with {QA_RESULTS},
answered as (select * exclude (generated_answer, judge_reply), {answer} as generated_answer from qa),
judged as (select *, {coin(judge_prompt('generated_answer'))} as judge_reply from answered)
select id, generated_answer, judge_reply, {verdict('judge_reply')} as is_correct_ai_eval from judged"""
    sql["reference_logprobs"] = f"with {QA_RESULTS} select id, round({token_perplexity('expected_answer')}, 6) as perplexity from qa"
    sql["embed_and_compare"] = f"""with {QA_RESULTS}
select id, round({letter_similarity('expected_answer', 'generated_answer')}, 6) as similarity from qa"""
    sql["knowledge_evaluation"] = f"""with {QA_RESULTS},
answered as (select * exclude (generated_answer, judge_reply), {answer} as generated_answer from qa),
judged as (select *, {coin(judge_prompt('generated_answer'))} as judge_reply from answered),
m as (select difficulty, {KEYWORD} as k, {verdict('judge_reply')} as j, {token_perplexity('expected_answer')} as p,
  {letter_similarity('expected_answer', 'generated_answer')} as s from judged) """ + grouped("m", "difficulty", full)

    unheard = f"""answered as (select * exclude (generated_answer, judge_reply), case when md5({TUNED_PROMPT}) < 'd' then {answer} end as generated_answer from qa),
asked as (select *, md5({judge_prompt('generated_answer')}) as h from answered),
judged as (select *, case when generated_answer is null then 'RuntimeError: no answer' when substring(h,2,1) = '0' then 'RuntimeError: no verdict' end as error from asked)"""
    sql["evaluation_with_failures"] = f"""with {QA_RESULTS}, {unheard}
select id, case when error is null then {KEYWORD} end as is_correct_keyword,
  case when error is null then coalesce({letter_similarity('expected_answer', 'generated_answer')} >= 0.7, false) end as is_correct_semantic,
  case when error is null then h < '8' end as is_correct_ai_eval, error from judged"""
    sql["evaluation_counts"] = f"""with {QA_RESULTS}, {unheard},
c as (select count(*) as n, count(*) filter (where generated_answer is null) as lost, count(error) as failed from judged)
select n as n_answers, lost as n_failed_by_answers, n as n_perplexity, lost as n_failed_by_perplexity, n as n_similarity, lost as n_failed_by_similarity,
  n as n_verdicts, failed as n_failed_by_verdicts from c"""

    sql["clean_pages"] = f"with c as (select page_id, {clean('html')} as text from pages) select page_id, length(text)::int as n_chars, md5(text) as text_md5 from c"
    sql["title_extract"] = f"""with t as (select page_id, {tag('html', 'title')} as title, {tag('html', 'article')} as article,
  {tag('html', 'h3')} as h3 from pages)
select page_id, title, article is not null as has_article, md5(coalesce(article, '')) as article_md5, h3 is not null as has_h3 from t"""
    sql["page_records"] = f"with {PAGES} select page_id, piece::int as piece, length(text)::int as n_chars, md5(text) as text_md5 from records"
    sql["chunk_documents"] = f"with {chunks('documents', 'doc_id')} select doc_id, chunk_no, length(chunk)::int as n_chars, md5(chunk) as chunk_md5 from chunks"
    sql["chunk_words"] = f"""with w as (select doc_id, string_split({collapse('text')}, ' ') as words from documents),
i as (select *, unnest(range(0, greatest(ceil((len(words)-20)/180.0), 1)::bigint)) as chunk_no from w)
select doc_id, chunk_no::int as chunk_no, md5(array_to_string(list_slice(words, chunk_no*180+1, chunk_no*180+200), ' ')) as chunk_md5 from i"""
    sql["truncate_tokens"] = f"""with w as (select doc_id, list_slice(string_split({collapse('text')}, ' '), 1, 100) as words from documents)
select doc_id, len(words)::int as n_words, md5(array_to_string(words, ' ')) as text_md5 from w"""
    pieces = r"'(?s)[a-z]{1,4}|[^a-z]'"
    sql["tokenizer_budget"] = f"""with t as (select doc_id, regexp_extract_all(text, {pieces}) as tokens from documents)
select doc_id, len(tokens)::int as n_tokens, md5(array_to_string(list_slice(tokens, 1, 64), '')) as kept_md5 from t"""
    sql["category_closure"] = f"""with recursive {EDGES},
reach as (select 'Category:{SEED_CATEGORY}' as node, 0 as depth union select member, depth+1 from reach join edges on category=node where depth < 3)
select distinct node as page from reach where not contains(node, 'Category:')"""

    contents = "md5(string_agg(content, chr(10) order by turn)) as contents_md5"
    roles = "string_agg(role, ',' order by turn) as roles"
    sql["build_conversations"] = f"""with {TURNS} select conv_id, count(*)::int as n_turns, {roles}, {contents}
from turns group by 1"""
    sql["qa_to_conversations"] = f"""with {QA_RESULTS} select id, 'system,user,assistant' as roles,
  md5({lit(V.DEFAULT_SYSTEM_TEXT)} || chr(10) || question || chr(10) || expected_answer) as contents_md5 from qa"""
    sql["replace_system_turn"] = f"""with {TURNS},
fixed as (select conv_id, turn, role, content from turns where not (turn=0 and role='system')
  union all select distinct conv_id, -1, 'system', {lit(SYSTEM_TEXT)} from turns)
select conv_id, {roles}, {contents} from fixed group by 1"""
    shown = "'<start_of_turn>' || case role when 'assistant' then 'model' else role end || chr(10) || content || '<end_of_turn>' || chr(10)"
    sql["render_chat"] = f"""with {TURNS}, r as (select conv_id, string_agg({shown}, '' order by turn) as text from turns group by 1)
select conv_id, md5(text) as text_md5, md5(text || {OPEN}) as open_md5 from r"""
    sql["useful_conversations"] = f"""with {USEFUL} select conv_id, count(*)::int as n_turns, {contents}
from turns where conv_id in (select conv_id from verdicts where useful) group by 1"""
    sql["long_conversations"] = f"""with turns as (select event_id%9 as conv_id, event_id//9 as turn,
  case when event_id//9=0 and event_id%9%2=0 then 'system' when event_id//9%2=0 then 'user' else 'assistant' end as role,
  case when event_id//9=50 and event_id%9 in (3,4) then props || {lit(NO_INFORMATION)} else props end as content from events),
fixed as (select conv_id, turn, role, content from turns where not (turn=0 and role='system')
  union all select distinct conv_id, -1, 'system', {lit(SYSTEM_TEXT)} from turns),
bad as (select conv_id from turns where {STOPPED}),
r as (select conv_id, string_agg({shown}, '' order by turn) as text from fixed where conv_id not in (select conv_id from bad) group by 1)
select conv_id, length(text)::int as n_chars, md5(text) as text_md5 from r"""
    sql["content_top50"] = f"""with {TURNS} select md5(content) as digest, length(content)::int as n_chars, count(*) as n
from turns where content is not null group by content order by n desc, digest limit 50"""
    sql["content_top50_sketched"] = sql["content_top50"]
    sql["train_eval_split"] = f"with {SPLIT} select conv_id, split from splits"
    sql["turns_with_split"] = f"""with {USEFUL}, {ranked('verdicts', 'conv_id', 0)},
k as (select *, least(60, n) as k from ranked),
s as (select conv_id, case when rank <= k - floor(k*0.1::double) then 'train' else 'eval' end as split from k where rank <= k)
select conv_id, turn, split, md5(content) as content_md5 from turns join s using (conv_id)"""
    sql["split_filter_counts"] = f"""with {SPLIT} select split, count(*) as n_before, count(*) filter (where useful) as n_after
from splits group by split"""
    sql["step_budget"] = f"""with {SPLIT}, c as (select count(*) as n from splits where split='train' and useful)
select n, ceil(n/8.0)::bigint as steps_per_epoch, ceil(n/8.0)::bigint as total_steps,
  greatest(1, floor(0.1::double*ceil(n/8.0)))::bigint as warmup_steps from c"""
    sql["merge_datasets"] = f"""with {TURNS},
merged as (select 'old|' || conv_id || '|' || turn as row_id, role, content from turns
  union all select 'new|' || conv_id || '|' || turn, role, content from turns where role='assistant'),
{ranked('merged', 'row_id', 42)} select rank, row_id, role, md5(content) as content_md5 from ranked"""

    synth = f"""{PAGES},
keyed as (select page_id || '-' || piece as record, text from records),
{chunks('keyed', 'record')}, {_pair_sql('record')},
built as (select record || '-' || chunk_no || '-' || pair_no as conv_id, question, answer from scored where rating >= 5),
{ranked('built', 'conv_id', 0)}"""
    stop = STOPPED.replace("content", "question || chr(10) || answer")
    sql["conversation_synthesis"] = f"""with {synth}
select conv_id, case when rank <= n - floor(n*0.1::double) then 'train' else 'eval' end as split, 'system,user,assistant' as roles,
  md5({lit(SYSTEM_TEXT)} || chr(10) || question || chr(10) || answer) as contents_md5 from ranked where not {stop}"""

    qa = f"with {chunks('documents', 'doc_id')}, {_pair_sql('doc_id')}"
    sql["qa_generate_curate"] = f"""{qa} select doc_id, chunk_no, pair_no, md5(question) as question_md5, md5(answer) as answer_md5, rating
from scored where rating >= 5"""
    sql["curation_counts"] = f"""{qa},
p as (select count(*) as n_pairs, count(*) filter (where rating >= 5) as n_kept,
  count(*) filter (where rating < 5) as n_below, count(*) filter (where rating is null) as n_unrated, count(*)::bigint as n_written from scored),
w as (select count(*) as n_chunks, count(*) filter (where refused) as n_unreadable_chunks from sized),
g as (select count(*) as n_prompts, count(*) filter (where mood='0') as n_unreadable_ratings, count(*) filter (where mood='1') as n_short,
  count(*) filter (where mood='2') as n_long, count(*) filter (where mood='2')::bigint as n_extra
from (select distinct doc_id, chunk_no, pair_no//4, mood from scored))
select * from p, w, g"""
    cut = f"with {chunks('documents', 'doc_id')}, {_cut_pair_sql('doc_id')}"
    sql["salvaged_pairs"] = f"""{cut},
q as (select doc_id, chunk_no, string_agg(question, '|' order by pair_no) as questions from pairs group by all)
select doc_id, chunk_no, case when whole > 0 or n = 0 then whole end::int as n_pairs, case when whole < n then whole else 0 end::int as n_salvaged,
  case when whole > 0 or n = 0 then md5(coalesce(questions, '')) end as questions_md5, case when h >= 'f' then 'RuntimeError: no reply' end as error
from replies left join q using (doc_id, chunk_no)"""
    sql["synthesis_counts"] = f"""{cut},
w as (select count(*) as n_chunks, count(*) filter (where h >= 'f') as n_failed_chunks,
  count(*) filter (where h < '2' or (whole = 0 and n > 0)) as n_unreadable_chunks, count(*) filter (where whole > 0 and whole < n) as n_cut_replies,
  coalesce(sum(whole) filter (where whole < n), 0)::bigint as n_salvaged, sum(whole)::bigint as n_written from replies),
g as (select count(*) as n_prompts, count(*) filter (where mood='3') as n_failed_ratings, count(*) filter (where mood='0') as n_unreadable_ratings,
  count(*) filter (where mood='1') as n_short, count(*) filter (where mood='2') as n_long from (select distinct doc_id, chunk_no, pair_no//4, mood from scored)),
p as (select count(*) as n_pairs, count(*) filter (where rating >= 5) as n_kept, count(*) filter (where rating < 5) as n_below,
  count(*) filter (where rating is null) as n_unrated from scored)
select * from w, g, p"""
    sql["json_pairs"] = """select event_type, count(*) as n,
  count(*) filter (where event_type not in ('click','view')) as n_unreadable,
  count(*) filter (where event_type = 'click') as n_high,
  coalesce(max(case when event_type in ('click','view') then 'q' || event_id end), '') as last_question from events group by event_type"""

    sql["parse_predictions"] = f"""with {PARSED} select doc_id, sentiment_pred, sentiment_tag_present, reasoning_tag_present,
  md5(reasoning_pred) as reasoning_pred_md5, md5(reasoning_or_raw) as reasoning_or_raw_md5 from parsed"""
    sql["tag_integrity"] = f"with {PARSED} {INTEGRITY}"
    sql["label_accuracy"] = f"with {PARSED} " + grouped(
        "parsed",
        "sentiment_true",
        {
            "accuracy_none": share("sentiment_true = sentiment_pred"),
            "accuracy_neutral": share("sentiment_true = case sentiment_pred when 'none' then 'neutral' else sentiment_pred end"),
        },
    )
    code = "case {} when 'negative' then 0 when 'positive' then 2 else 1 end"
    true_code, pred_code = code.format("sentiment_true"), code.format("sentiment_pred")
    sql["label_codes"] = f"""with {PARSED} select doc_id, {true_code} as true_code, {pred_code} as pred_code,
  sentiment_true as true_name from parsed"""
    sql["confusion_matrix"] = f"""with {PARSED}, c as (select {true_code} as truth, {pred_code} as pred, count(*) as n from parsed group by 1, 2),
grid as (select t.t as truth, p.p as pred from (select unnest([0,1,2]) as t) t, (select unnest([0,1,2]) as p) p)
select truth, pred, coalesce(n, 0) as n from grid left join c using (truth, pred)"""
    sql["classification_report"] = f"""with {PARSED}, {REPORT}
select label, round(precision,6) as precision, round(recall,6) as recall, round(f1,6) as f1, support::bigint as support from report"""
    sql["class_counts"] = f"with {LABELLED} select sentiment_true, count(*) as n from labelled group by 1"
    defaulted = "lower(reasoning_pred) = 'none'"
    sql["reasoning_score"] = f"""with {PARSED}, s as (select {defaulted} as d, case when {defaulted} then 1 else {SCORE} end as score from parsed)
select count(*) as n, count(score) as n_scored, count(*) filter (where score is null) as n_unreadable,
  count(*) filter (where d) as n_defaulted, round(avg(score), 6) as mean_score from s"""
    sql["stratified_sample"] = f"""with {LABELLED},
r as (select *, row_number() over (partition by sentiment_true order by md5('42|' || doc_id)) as k from labelled)
select doc_id, sentiment_true, md5(text) as text_md5 from r where k <= 34"""
    sql["stratified_sample_open"] = """with r as (select *, row_number() over (partition by source order by md5('42|' || doc_id)) as k
  from documents where source is not null) select doc_id, source from r where k <= 10"""
    sql["first_k_sample"] = f"with {ranked('documents', 'doc_id', 5)} select doc_id, md5(text) as text_md5 from ranked where rank <= 100"
    answer_tags = fill(V.TAGGED_ANSWER_TEMPLATE, sentiment="sentiment_true", reasoning="reasoning")
    user = turn("user", classify_body("text"))
    sql["sentiment_prompts"] = f"""with {LABELLED}, l as (select *, text as reasoning from labelled)
select doc_id, md5({user} || {turn('model', answer_tags)}) as train_md5, md5({user} || {OPEN}) as test_md5,
  md5({explain_prompt('text', 'sentiment_true')}) as explain_md5,
  md5({reasoning_prompt('text', 'sentiment_true', 'reasoning')}) as judge_md5,
  md5({lit(V.SUMMARY_TEMPLATE)} || chr(10) || text) as summary_md5,
  md5('"' || text || '"' || chr(10) || '<end_of_turn>' || chr(10) || {OPEN}) as headline_md5 from l"""
    sql["explanations"] = f"""with {LABELLED} select doc_id, {true_code} as label, sentiment_true as sentiment,
  case doc_id%10 when 0 then 'test' when 1 then 'validation' else 'train' end as split,
  'Because ' || md5({explain_prompt('text', 'sentiment_true')}) as explanation from labelled"""
    told = f"md5({explain_prompt('text', 'sentiment_true')})"
    sql["failed_explanations"] = f"""with {LABELLED} select doc_id, case when {told} >= '4' then 'Because ' || {told} end as explanation,
  case when {told} < '4' then 'ValueError: no answer' end as error from labelled"""
    sql["retried_explanations"] = f"""with {LABELLED}, t as (select doc_id, {told} as h from labelled)
select doc_id, case when h < 'e' then 'Because ' || h end as explanation,
  case when h >= 'f' then 'ValueError: not to be answered' when h >= 'e' then 'ConnectionError: try again' end as error,
  (case when h < '4' then 3 when h >= 'f' then 1 when h >= 'e' then 4 else 1 end)::int as attempts from t"""
    sql["budgeted_explanations"] = f"""with {LABELLED}, t as (select doc_id, regexp_extract_all({explain_prompt('text', 'sentiment_true')}, {pieces}) as tokens from labelled)
select doc_id, 'Because ' || md5(array_to_string(list_slice(tokens, 1, 300), '')) as explanation, len(tokens)::int as n_tokens from t"""
    sql["predict_with_reasoning"] = f"with {PARSED} select doc_id, sentiment_pred, md5(reasoning_or_raw) as reasoning_pred_md5 from parsed"
    sql["score_reasoning"] = f"""with {PARSED} select doc_id, sentiment_pred,
  (case when {defaulted} then 1 else {SCORE} end)::double as reasoning_score from parsed"""
    sql["resumed_predictions"] = sql["score_reasoning"]
    sql["sentiment_evaluation"] = f"""with {PARSED}, {REPORT}, tags as ({INTEGRITY})
select 'f1 ' || label as metric, round(f1, 6) as value from report
union all select 'both tags', both_rate from tags
union all select 'mean reasoning score', round(avg(case when {defaulted} then 1 else {SCORE} end), 6) from parsed"""
    sql["review_head"] = f"""with {PARSED} select doc_id, sentiment_true, sentiment_pred, md5(text) as text_md5
from parsed order by doc_id limit 10"""

    sql["training_curves"] = f"""with {LOGS} select 'train' as series, step, epoch, loss from logs where loss is not null
union all select 'eval', step, epoch, eval_loss from logs where eval_loss is not null"""
    sql["best_checkpoint"] = f"""with {LOGS}, e as (select *, count(*) over () as n_evals from logs where eval_loss is not null)
select step, eval_loss, n_evals from e order by eval_loss, step limit 1"""

    sql["text_corpus_scan"] = f"""with t as (select doc_id//{SHARD_ROWS} as file_index, {strip("string_agg(text, chr(10) order by doc_id)")} as text from documents group by 1)
select file_index, length(text)::int as n_chars, md5(text) as text_md5 from t where text <> ''"""
    sql["artifact_sizes"] = """select lang, sum(strlen(text)+1)::bigint as n_bytes, round(sum(strlen(text)+1)/1073741824.0::double, 6) as gb
from documents group by lang"""
    sql["csv_roundtrip"] = f"""with {PARSED} select doc_id, md5(text) as text_md5, sentiment_true as y_true, sentiment_pred as y_pred,
  md5(reasoning_pred) as reasoning_md5 from parsed"""
    sql["jsonl_roundtrip"] = f"with {TURNS} select conv_id, {roles}, {contents} from turns group by 1"
    sql["json_arrays_roundtrip"] = sql["jsonl_roundtrip"]
    sql["json_array_lines"] = sql["jsonl_roundtrip"]
    sql["records_roundtrip"] = "select 'doc_' || doc_id || '.txt' as source, md5(text) as text_md5 from documents"
    sql["split_roundtrip"] = f"""with {ranked('documents', 'doc_id', 3)}
select doc_id, upper(lang) as lang from ranked where rank > n - floor(n*0.1::double)"""
    sql["publish_versions"] = f"with {TURNS} select conv_id || '|' || turn as row_id, role, md5(content) as content_md5 from turns"
    return sql
