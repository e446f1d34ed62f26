"""DuckDB twins of the registered queries, on the same parquet tables."""

from __future__ import annotations

from fixtures.queries import PAGE_URL, PARAMS, RULES
from fixtures.views import PAGED_WORKS_SQL, VIEWS, view_sql
from pubwatch.functions import fixed
from pubwatch.operators import rendering, summaries

SPACE = (
    r"[\t\n\v\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
TOKEN = r"[\p{L}\p{N}]{4,}"
SINCE = "date '1999-08-02'"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sentences(expr: str) -> str:
    flat = f"regexp_replace({expr}, '{SPACE}+', ' ', 'g')"
    found = f"regexp_extract_all({flat}, '[^.!?]+[.!?]*')"
    return f"list_filter(list_transform({found}, lambda s: trim(s)), lambda s: s <> '')"


def escaped(expr: str) -> str:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        expr = f"replace({expr}, '{char}', '{entity}')"
    return expr


def filled(template: str, **values: str) -> str:
    """A template as a concatenation of literals and SQL expressions."""
    out = lit(template)
    for name, expr in values.items():
        out = out.replace("{" + name + "}", f"' || coalesce({expr}, '') || '")
    return f"({out})"


def q(names: str, body: str, **extra: str) -> str:
    """``body`` with the named views, and ``extra`` ones after them, as common table expressions."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for used in VIEWS[name][0]:
            if used in VIEWS:
                add(used)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        add(name)
    parts = [f"{n} as ({view_sql(n)})" for n in wanted] + [f"{n} as ({s})" for n, s in extra.items()]
    return f"with {', '.join(parts)} {body}" if parts else body


ENRICHED = "select * from works join journals using (issn)"
ENRICHED_BIG = "select * from works_big join journals_big using (issn)"
ARCHIVE = """
    select work_id, subject, coalesce(journal_name, 'Unknown Journal') as journal_name,
           coalesce(title, 'Untitled') as title, publication_date, grade,
           coalesce(cited_by_count, 0) as citations, coalesce(doi, id) as link
    from works join journals using (issn)
"""
ROW7 = "subject, journal_name, title, publication_date, grade, citations, link"
ROW6 = "subject, journal_name, title, publication_date, citations, link"


def archive_q(body: str) -> str:
    return q("works journals", body, archive=ARCHIVE)


# A page is in the chain if it was fetched, has results and its request cursor is the one that the
# page before gave.
CHAIN = {
    "paged": PAGED_WORKS_SQL,
    "pages": """
        select issn, page_no, any_value(status) as status, any_value(request_cursor) as request_cursor,
               any_value(next_cursor) as next_cursor,
               case when any_value(status) = 200 then count(*) else 0 end as n_works
        from paged group by issn, page_no
    """,
    "flags": """
        select *, min(case when status = 200 and n_works > 0 and request_cursor is not distinct from
                        case when page_no = 1 then '*' else before_cursor end
                      then 1 else 0 end)
                  over (partition by issn order by page_no rows unbounded preceding) as kept
        from (select *, lag(next_cursor) over (partition by issn order by page_no) as before_cursor
              from pages) p
    """,
    "landed_works": """
        select id as work_id, p.issn, title, publication_date, cited_by_count, doi, id, journal_name,
               abstract, subject, grade
        from paged p join flags f on p.issn = f.issn and p.page_no = f.page_no and f.kept = 1
    """,
}

NUMBER = "cast(regexp_extract(id, '[0-9]+$') as bigint)"
SUMMARY_EN = (
    f"case when abstract is not null and abstract <> '' "
    f"then array_to_string(({sentences('abstract')})[1:2], ' ') else {lit(fixed.NO_ABSTRACT[0])} end"
)
SUMMARY_HE = (
    f"case when abstract is not null and abstract <> '' "
    f"then {lit(fixed.ARTICLE_UNLABELLED_HE)} else {lit(fixed.NO_ABSTRACT[1])} end"
)
T = rendering.DEFAULT

DIGEST = {
    "paged": f"""
        select *, row_number() over (partition by issn order by publication_date desc, work_id) as pos
        from works join journals using (issn)
        where grade = 'Q1' and publication_date >= {SINCE}
        qualify pos <= 15
    """,
    "selected": """
        select *, row_number() over (partition by subject order by journal_ord, pos) as paper_no
        from (select *, min(journal_ord) over (partition by subject) as section_ord from paged) p
        where abstract is not null and abstract <> ''
        qualify paper_no <= 5
    """,
    "articles": f"""
        select *, 'art-' || article_no as article_id, {SUMMARY_EN} as summary_en,
               {SUMMARY_HE} as summary_he
        from (select row_number() over (order by journal_ord, pos) as article_no, paper_no, subject,
                     section_ord, work_id, abstract, coalesce(title, 'Untitled') as title,
                     coalesce(journal_name, 'Unknown Journal') as journal_name,
                     coalesce(doi, id) as link
              from selected) s
    """,
    "spoken": f"""
        select subject, paper_no, unnest(parts) as sentence, generate_subscripts(parts, 1) as sentence_no
        from (select subject, paper_no, {sentences('abstract')} as parts from articles) a
    """,
    "used": f"""
        select subject, paper_no, sentence_no,
               unnest(list_distinct(regexp_extract_all(lower(sentence), '{TOKEN}'))) as token
        from spoken
    """,
    "shared": """
        select subject, token from used group by subject, token having count(distinct paper_no) >= 2
    """,
    "scores": """
        select subject, paper_no, sentence_no, count(*) as score
        from used join shared using (subject, token) group by all
    """,
    "best": """
        select * from spoken left join scores using (subject, paper_no, sentence_no)
        qualify row_number() over (partition by subject
                  order by coalesce(score, 0) desc, paper_no, sentence_no) <= 3
    """,
    "domains": f"""
        select subject, string_agg(sentence, ' ' order by paper_no, sentence_no) as domain_summary_en,
               {lit(fixed.DOMAIN_UNLABELLED_HE)} as domain_summary_he
        from best group by subject
    """,
    "briefing": f"""
        select string_agg('<a href=''#' || article_id || '''>'
                 || {escaped('(' + sentences('summary_en') + ')[1]')} || '</a>',
                 ' ' order by section_ord, paper_no) as briefing_en,
               {lit(fixed.GLOBAL_UNLABELLED_HE)} as briefing_he, count(*) as n_findings
        from articles having count(*) > 0
    """,
    "cards": f"""
        select article_id, article_no, subject, section_ord, {filled(
            T.card, article_id='article_id', title=escaped('title'), journal=escaped('journal_name'),
            summary_en=escaped('summary_en'), summary_he=escaped('summary_he'), link=escaped('link')
        )} as card from articles
    """,
    "sections": f"""
        select subject, section_ord, n_articles,
               {filled(T.heading, subject=escaped('subject'))}
               || case when domain_summary_en <> '' or domain_summary_he <> '' then {filled(
                    T.executive, summary_en=escaped('domain_summary_en'),
                    summary_he=escaped('domain_summary_he'))} else '' end || cards as section
        from (select subject, section_ord, count(*) as n_articles,
                     string_agg(card, '' order by article_no) as cards
              from cards group by subject, section_ord) c
        left join domains using (subject)
    """,
    "contexts": """
        select subject, string_agg('Paper ' || paper_no || ': ' || title || chr(10) || 'Key Finding: '
                          || summary_en || chr(10) || chr(10), '' order by paper_no) as context
        from articles group by subject
    """,
    "whole": """
        select string_agg('-[ID: ' || article_id || '] Title: ' || title || '. Core Discovery: '
                          || summary_en || chr(10), '' order by article_no) as context,
               count(*) as n_articles
        from articles having count(*) > 0
    """,
}


def stub_answer(request: str, tier: summaries.Tier) -> tuple[str, str]:
    """What the stand-in summariser leads to for a request, in both languages."""
    size = f"length({request})"

    def text(i: int, unlabelled: str, labelled: str) -> str:
        return f"""case {size} % 7 when 0 then {lit(tier.exhausted[i])} when 1 then {lit(tier.failed[i])}
            when 2 then {unlabelled} else {labelled} end"""

    words = f"{size} || ' characters'"
    return text(0, words, words), text(1, lit(tier.unlabelled_he), f"cast({size} as varchar)")


ARTICLE_ANSWER = stub_answer(
    filled(summaries.ARTICLE_REQUEST, title="title", abstract="abstract"), summaries.ARTICLE
)
DOMAIN_ANSWER = stub_answer(
    filled(summaries.DOMAIN_REQUEST, subject="subject", context="context"), summaries.DOMAIN
)
GLOBAL_ANSWER = stub_answer(filled(summaries.GLOBAL_REQUEST, context="context"), summaries.GLOBAL)
SUMMARISED = {
    **DIGEST,
    "articles": f"""
        select * exclude (summary_en, summary_he), {ARTICLE_ANSWER[0]} as summary_en,
               {ARTICLE_ANSWER[1]} as summary_he
        from ({DIGEST['articles']}) a
    """,
}
RUN_PAGE = f"{PARAMS.base_url}/{PARAMS.file_prefix}{PARAMS.as_of.isoformat()}.html"


def digest_q(body: str) -> str:
    return q("works journals", body, **DIGEST)


def linked(expr: str, url: str) -> str:
    target = 'href="' + url.replace("\\", "\\\\") + '#\\1"'
    return f"regexp_replace({expr}, {lit(fixed.ANCHOR_LINK_PATTERN)}, {lit(target)}, 'g')"


def labels(expr: str, fallback: str) -> tuple[str, str]:
    text = strip(expr)
    both = f"contains({text}, 'English:') and contains({text}, 'Hebrew:')"
    en = strip(f"replace(split_part({text}, 'Hebrew:', 1), 'English:', '')")
    he = strip(f"split_part({text}, 'Hebrew:', 2)")
    return (
        f"case when {both} then {en} else {text} end",
        f"case when {both} then {he} when response is not null then {lit(fallback)} end",
    )


def outcome_select(name: str, tier: summaries.Tier) -> str:
    en, he = labels("response", tier.unlabelled_he)
    if tier.codes is None:
        again = "error is not null"
    else:
        again = " or ".join(f"contains(error, '{code}')" for code in tier.codes)

    def text(i: int, answer: str) -> str:
        return f"""case status when 'no_abstract' then {lit(tier.missing[i])}
            when 'failed' then {lit(tier.failed[i])} when 'exhausted' then {lit(tier.exhausted[i])}
            when 'retryable' then null else {answer} end"""

    return f"""
        select '{name}' as tier, conv_id, turn, status, {text(0, en)} as en, {text(1, he)} as he
        from (select *, case when not has_input then 'no_abstract'
                    when error is null and response is null then 'failed'
                    when error is null then case when contains(response, 'English:')
                        and contains(response, 'Hebrew:') then 'ok' else 'unlabelled' end
                    when not ({again}) then 'failed'
                    when attempts >= 3 then 'exhausted' else 'retryable' end as status
              from attempts) a
    """


def restyled() -> str:
    expr = "html"
    for rule in RULES:
        if rule.kind == "literal":
            expr = f"replace({expr}, {lit(rule.pattern)}, {lit(rule.replacement)})"
        else:
            new = rule.replacement.replace("\\", "\\\\")
            expr = f"regexp_replace({expr}, {lit(rule.pattern)}, {lit(new)}, 'g')"
    return expr


def dashboard(subjects: str) -> str:
    return f"""subject in ({subjects}) and grade = 'Q1'
        and publication_date between date '1996-04-01' and date '2000-12-31'"""


METADATA = """
    select journal_name, grade as journal_grade from landed_works
    qualify row_number() over (partition by issn order by publication_date desc, work_id) = 1
"""
DASHBOARD = dashboard("'AFRICA', 'ASIA', 'EUROPE'")
DASHBOARD_BIG = dashboard("'NATION_1', 'NATION_5', 'NATION_9', 'NATION_17'")
PULLS = f"""
    select l_orderkey, l_linenumber, issn, publication_date, cited_by_count from works_big
    union all
    select l_orderkey, l_linenumber, issn, publication_date, cited_by_count from works_big
    where publication_date >= {SINCE}
    union all
    select l_orderkey, l_linenumber, issn, publication_date, cited_by_count from works_big
    where publication_date >= date '2001-07-25'
"""
WORDS = f"list_filter(regexp_split_to_array(text, '{SPACE}+'), lambda w: w <> '')"
REQUEST = filled(
    summaries.ARTICLE_REQUEST, title="coalesce(title, 'Untitled')", abstract="abstract"
)


def volume(period: str) -> str:
    return q(
        "works_big",
        f"""select cast(date_trunc('{period}', publication_date) as date) as period_start,
            count(*) as n_articles from works_big group by 1""",
    )


def windows(starts: str) -> str:
    return f"""
        select window_start, window_start + interval 7 day as window_end, event_type,
               count(*) as n_events
        from (select event_type, {starts} as window_start from events) e group by all
    """


WEEK = "time_bucket(interval '7 days', ts, timestamp '1970-01-01')"


# The archive after two pulls, of which the second has newer versions of recent works.
UPSERTED = f"""select work_id, subject, journal_name, title, grade, link,
      case when recent then publication_date + 40 else publication_date end as publication_date,
      case when recent then citations + 5 else citations end as citations,
      case when recent then date '2001-08-01' else date '2001-07-25' end as pulled_on
    from (select *, publication_date >= {SINCE} as recent from archive) a"""


# Columns that are dates or times in the twins, per query.
PUBLISHED = """
    works_from_pages works_from_raw_pages archive_refresh snapshot_guard first_page_per_journal archive_snapshot
    archive_append archive_rows archive_rows_legacy archive_fillna recent_works works_in_years dashboard_filtered works_enriched
    archive_with_grade digest_selection archive_sorted dashboard_main_table union_batches
    union_schema_drift dedup_works archive_daily dashboard_by_journal stream_ingest stream_ingest_pages stream_upsert stream_enrich
""".split()
TEMPORAL: dict[str, tuple[str, ...]] = {
    **dict.fromkeys(PUBLISHED, ("publication_date",)),
    **dict.fromkeys(("volume_by_month", "volume_by_quarter", "filtered_volume", "counted_volume"), ("period_start",)),
    **dict.fromkeys(("digest_html", "digest_published", "run_artifacts"), ("run_date",)),
    **dict.fromkeys(
        ("stream_weekly_counts", "stream_rolling_counts", "stream_closed_windows"),
        ("window_start", "window_end"),
    ),
    **dict.fromkeys(("archive_upsert", "archive_compacted", "stream_merge_pages"), ("publication_date", "pulled_on")),
    "stream_dedup": ("day",),
}


def iso_dates(sql: str, columns: tuple[str, ...]) -> str:
    if not columns:
        return sql
    casts = ", ".join(f"cast({c} as varchar) as {c}" for c in columns)
    return f"select * replace ({casts}) from ({sql}) r"


def all_oracles() -> dict[str, str]:
    """Twin of every registered query, with dates and times as ISO text."""
    return {name: iso_dates(sql, TEMPORAL.get(name, ())) for name, sql in _twins().items()}


def _twins() -> dict[str, str]:
    return {
        "journal_registry": q(
            "journals_big",
            "select issn, cast(journal_ord as int) as journal_ord, subject, grade from journals_big",
        ),
        "works_from_pages": q(
            "works journals",
            f"""select work_id, issn, title, publication_date, cited_by_count, doi, journal_name,
                md5(nullif({strip(f"regexp_replace(abstract, '{SPACE}+', ' ', 'g')")}, ''))
                  as abstract_md5
                from landed_works""",
            **CHAIN,
        ),
        "works_from_raw_pages": q(
            "works journals",
            f"""select work_id, issn, title, publication_date, cited_by_count, doi, journal_name,
                md5(nullif({strip(f"regexp_replace(abstract, '{SPACE}+', ' ', 'g')")}, ''))
                  as abstract_md5,
                case when title is not null then 'set' when {NUMBER} % 2 = 0 then 'null'
                     else 'missing' end as title_state,
                case when title is not null then title when {NUMBER} % 2 = 0 then ''
                     else 'Untitled' end as archive_title
                from landed_works""",
            **CHAIN,
        ),
        "undeclared_work_fields": q(
            "works journals",
            f"""select work_id, 'type' as field, '"article"' as value from landed_works where {NUMBER} % 3 = 0
                union all
                select work_id, 'open_access', '{{"is_oa":true}}' from landed_works where {NUMBER} % 5 = 0
                union all
                select work_id, 'primary_location.version', '"v1"' from landed_works
                where {NUMBER} % 7 = 0 and {NUMBER} % 13 <> 0""",
            **CHAIN,
        ),
        "cursor_chain_prefix": q(
            "works journals", "select issn, page_no, n_works from flags where kept = 1", **CHAIN
        ),
        "stream_cursor_chain": q(
            "works journals", "select issn, page_no, n_works from flags where kept = 1", **CHAIN
        ),
        "first_page_per_journal": q(
            "works",
            """select issn, row_number() over (partition by issn
                 order by publication_date desc, work_id) as pos, work_id, publication_date
               from works qualify pos <= 15""",
        ),
        "journal_metadata": q("works journals", METADATA, **CHAIN),
        "archive_snapshot": q(
            "works journals",
            """select subject, journal_name, coalesce(title, 'Untitled') as title,
                 publication_date, grade, cited_by_count as citations, coalesce(doi, id) as link
               from landed_works""",
            **CHAIN,
        ),
        "archive_refresh": q(
            "works journals",
            """select subject, journal_name, coalesce(title, 'Untitled') as title,
                 publication_date, grade, cited_by_count as citations, coalesce(doi, id) as link
               from landed_works
               where issn not in (select issn from flags where kept = 0)
                 and year(publication_date) between 1995 and 2001
               union all
               select subject, journal_name, coalesce(title, 'Untitled'), publication_date, grade,
                 cited_by_count + 1000, coalesce(doi, id)
               from works join journals using (issn)
               where issn in (select issn from flags where kept = 0)""",
            **CHAIN,
        ),
        "archive_daily": q(
            "works journals",
            """select subject, journal_name, coalesce(title, 'Untitled') as title,
                 publication_date, grade, cited_by_count as citations, coalesce(doi, id) as link
               from landed_works
               where publication_date >= date '2001-07-31'
                 or issn not in (select issn from flags where kept = 0)
                   and year(publication_date) between 1995 and 2001""",
            **CHAIN,
        ),
        "snapshot_guard": q(
            "works journals",
            f"""select {ROW7} from archive
                where publication_date >= {SINCE} or exists (select 1 from flags where kept = 0)""",
            archive=ARCHIVE,
            **CHAIN,
        ),
        "metadata_table": q("works journals", METADATA, **CHAIN),
        "archive_append": archive_q(
            f"""select {ROW7} from archive union all
                select subject, journal_name, title, publication_date, null, citations, link
                from archive where publication_date >= {SINCE}"""
        ),
        "archive_upsert": archive_q(UPSERTED),
        "archive_compacted": archive_q(
            f"select * from ({UPSERTED}) u where date_trunc('month', publication_date) = date '1998-03-01'"
        ),
        "counted_distribution": archive_q(
            f"""select subject, count(*) as n_articles,
                round(count(*) / (sum(count(*)) over ()), 6) as share from ({UPSERTED}) u group by subject"""
        ),
        "counted_volume": archive_q(
            f"""select cast(date_trunc('quarter', publication_date) as date) as period_start,
                count(*) as n_articles from ({UPSERTED}) u where grade in ('Q1', 'Q2') group by 1"""
        ),
        "archive_rows": archive_q(f"select {ROW7} from archive"),
        "archive_rows_legacy": archive_q(f"select {ROW6} from archive"),
        "digest_articles": digest_q(
            """select article_id, article_no, subject, title, journal_name, link, summary_en, summary_he
               from articles"""
        ),
        "article_link": q("works", "select work_id, coalesce(doi, id) as link from works"),
        "archive_fillna": archive_q(
            f"""select {ROW7} from archive union all
                select subject, journal_name, title, publication_date, '', citations, link from archive"""
        ),
        "q1_journals": q(
            "journals_big", "select issn, subject, grade from journals_big where grade = 'Q1'"
        ),
        "recent_works": q(
            "works_big",
            f"""select work_id, issn, publication_date from works_big
                where publication_date >= {SINCE}""",
        ),
        "works_in_years": q(
            "works_big",
            """select work_id, issn, publication_date from works_big
               where year(publication_date) between 1996 and 1999""",
        ),
        "registered_works": q(
            "works_big journals_big",
            """select work_id, issn, cited_by_count from works_big
               where issn in (select issn from journals_big where grade = 'Q1')""",
        ),
        "works_with_abstract": q(
            "works",
            """select work_id, md5(abstract) as abstract_md5 from works
               where abstract is not null and abstract <> ''""",
        ),
        "dashboard_filtered": archive_q(f"select {ROW7} from archive where {DASHBOARD}"),
        "works_enriched": q(
            "works_big journals_big",
            """select issn, work_id, publication_date, cited_by_count, journal_name, subject, grade
               from works_big join journals_big using (issn)""",
        ),
        "archive_with_grade": archive_q(
            f"""select {ROW6}, journal_grade from archive left join
                  (select journal_name, min(grade) as journal_grade from journals
                   where issn in (select issn from works) group by 1) m using (journal_name)"""
        ),
        "grade_conflicts": q(
            "journals_big",
            """select issn, grade as left_grade, 'Q1' as right_grade from journals_big
               where grade <> 'Q1'""",
        ),
        "journals_without_works": q(
            "works journals",
            f"""select issn, subject, grade from journals
                where issn not in (select issn from works where publication_date >= {SINCE})""",
        ),
        "dangling_anchors": digest_q(
            """, links as (select distinct unnest(regexp_extract_all(briefing_en,
                   'href=[''"]#(art-\\d+)[''"]', 1)) as anchor from briefing)
               select anchor, 'no article' as problem from links
               where anchor not in (select article_id from articles)
               union all
               select article_id, 'never linked' from articles
               where article_id not in (select anchor from links)"""
        ),
        "kpi_articles": q(
            "works_big journals_big",
            f"select count(*) as n_articles from ({ENRICHED_BIG}) e where {DASHBOARD_BIG}",
        ),
        "subject_distribution": q(
            "works_big journals_big",
            f"""select subject, count(*) as n_articles,
                round(count(*) / (sum(count(*)) over ()), 6) as share from ({ENRICHED_BIG}) e
                group by subject""",
        ),
        "articles_per_journal": q(
            "works_big", "select issn, count(*) as n_articles from works_big group by issn"
        ),
        "run_summary": digest_q(
            """select count(*) as n_articles, count(distinct subject) as n_subjects,
               count(distinct journal_name) as n_journals from articles"""
        ),
        "journals_by_domain": q(
            "journals_big",
            """select subject, count(*) as n_journals, count(*) filter (grade = 'Q1') as q1,
               count(*) filter (grade = 'Q2') as q2, count(*) filter (grade = 'Q1/Q2') as q1_q2
               from journals_big group by subject""",
        ),
        "volume_by_month": volume("month"),
        "volume_by_quarter": volume("quarter"),
        "filtered_volume": q(
            "works_big journals_big",
            f"""select cast(date_trunc('quarter', publication_date) as date) as period_start,
                count(*) as n_articles from ({ENRICHED_BIG}) e where {DASHBOARD_BIG} group by 1""",
        ),
        "filtered_distribution": q(
            "works_big journals_big",
            f"""select subject, count(*) as n_articles,
                round(count(*) / (sum(count(*)) over ()), 6) as share from ({ENRICHED_BIG}) e
                where {DASHBOARD_BIG} group by subject""",
        ),
        "domain_context": digest_q("select * from contexts"),
        "global_context": digest_q("select * from whole"),
        "fetch_completeness": q(
            "works journals",
            """select j.issn, coalesce(pages_landed, 1) as pages_landed,
                 coalesce(pages_kept, 0) as pages_kept, coalesce(works_kept, 0) as works_kept,
                 coalesce(failed, false) as failed
               from journals j left join (
                 select issn, count(*) as pages_landed, cast(sum(kept) as bigint) as pages_kept,
                   cast(sum(case when kept = 1 then n_works else 0 end) as bigint) as works_kept,
                   min(kept) = 0 as failed
                 from flags group by issn) f on j.issn = f.issn""",
            **CHAIN,
        ),
        "digest_selection": digest_q(
            "select subject, paper_no, issn, work_id, publication_date from selected"
        ),
        "digest_from_pages": q(
            "works journals",
            f"""select subject, row_number() over (partition by subject order by journal_ord, pos)
                  as paper_no, work_id, md5(abstract) as abstract_md5
                from (select l.work_id, j.subject, j.journal_ord,
                        nullif(array_to_string(list_filter(regexp_split_to_array(l.abstract,
                          '{SPACE}+'), lambda w: w <> ''), ' '), '') as abstract,
                        row_number() over (partition by issn
                          order by l.publication_date desc, l.work_id) as pos
                      from landed_works l join journals j using (issn)
                      where j.grade = 'Q1' and l.publication_date >= {SINCE}
                      qualify pos <= 15) p
                where abstract is not null
                qualify paper_no <= 5""",
            **CHAIN,
        ),
        "archive_sorted": q(
            "works_big journals_big",
            f"""select journal_name, publication_date, work_id, cited_by_count as citations,
                row_number() over (order by journal_name, publication_date desc, work_id,
                  cited_by_count) as row_no from ({ENRICHED_BIG}) e""",
        ),
        "dashboard_main_table": archive_q(
            f"""select publication_date, journal_name, '<a href="' || {escaped('link')} || '">'
                || {escaped('title')} || '</a>' as title_link from archive where {DASHBOARD}"""
        ),
        "digest_sections": digest_q(
            """select subject, cast(section_ord as bigint) as section_ord, n_articles,
               md5(section) as section_md5 from sections"""
        ),
        "union_batches": q("works_big", PULLS),
        "union_schema_drift": archive_q(
            f"""select {ROW7} from archive union all
                select subject, journal_name, title, publication_date, null, citations, link
                from archive"""
        ),
        "dedup_works": q(
            "works_big",
            f"""select * from ({PULLS}) p
                qualify row_number() over (partition by l_orderkey, l_linenumber
                  order by publication_date desc, cited_by_count desc, issn) = 1""",
        ),
        "dashboard_by_journal": archive_q(
            f"""select {ROW7} from archive where journal_name in ('NATION_1', 'NATION_12', 'NATION_20')
                and grade in ('Q1', 'Q2')"""
        ),
        "planted_dangling": digest_q(
            """select article_id as anchor, 'no article' as problem from articles where article_no = 2"""
        ),
        "restore_abstract": f"""
            select doc_id, md5(nullif(array_to_string({WORDS}, ' '), '')) as abstract_md5,
                   md5(nullif(array_to_string({WORDS}, '  '), '')) as gapped_md5
            from documents
        """,
        "inverted_index_stats": f"""
            select doc_id, word, count(*) as n_places, min(place) as first_place,
                   max(place) as last_place
            from (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) - 1 as place
                  from (select doc_id, {WORDS} as ws from documents) d) p
            group by doc_id, word
        """,
        "parse_bilingual": q(
            "bilingual_responses",
            "select conv_id, turn, {} as en, {} as he from bilingual_responses".format(
                *labels("response", fixed.ARTICLE_UNLABELLED_HE)
            ),
        ),
        "rewrite_anchor_links": q(
            "linked_texts", f"select doc_id, md5({linked('html', PAGE_URL)}) as html_md5 from linked_texts"
        ),
        "link_anchors": q(
            "linked_texts",
            f"""select doc_id, unnest(anchors) as anchor, generate_subscripts(anchors, 1) - 1 as pos
                from (select doc_id, regexp_extract_all(html, {lit(fixed.ANCHOR_LINK_PATTERN)}, 1)
                        as anchors from linked_texts) t""",
        ),
        "split_recipients": f"""
            select doc_id, unnest(parts) as recipient, generate_subscripts(parts, 1) - 1 as pos
            from (select doc_id, list_filter(list_transform(string_split(text, ','),
                    lambda part: {strip('part')}), lambda part: part <> '') as parts
                  from documents) d
        """,
        "article_cards": digest_q("select article_id, subject, md5(card) as card_md5 from cards"),
        "digest_html": digest_q(
            f"""select date '2001-08-01' as run_date, cast(n_articles as bigint) as n_articles,
                md5({filled(T.page, briefing_en='briefing_en', briefing_he='briefing_he',
                            sections='sections')}) as html_md5
                from (select string_agg(section, '' order by section_ord) as sections,
                             sum(n_articles) as n_articles from sections) s, briefing"""
        ),
        "digest_published": digest_q(
            f"""select date '2001-08-01' as run_date,
                md5({filled(T.page, briefing_en='briefing_en', briefing_he='briefing_he',
                            sections='sections')} || chr(10)) as value_md5
                from (select string_agg(section, '' order by section_ord) as sections
                      from sections) s, briefing"""
        ),
        "digest_teaser": digest_q(
            f"""select md5({filled(T.teaser, briefing_en=linked('briefing_en', RUN_PAGE),
                briefing_he=linked('briefing_he', RUN_PAGE), page_url=lit(RUN_PAGE))}) as html_md5
                from briefing"""
        ),
        "html_restyle": f"select page_id, md5({restyled()}) as html_md5 from pages",
        "pages_rewritten": f"select page_id, url, md5({restyled()}) as html_md5 from pages",
        "run_artifacts": q(
            "works_big",
            f"""select run_date, file_name, '{PARAMS.base_url}/' || file_name as page_url
                from (select run_date, '{PARAMS.file_prefix}' || strftime(run_date, '%Y-%m-%d')
                        || '.html' as file_name
                      from (select distinct publication_date as run_date from works_big) d) r""",
        ),
        "title_preview": q(
            "works", "select work_id, left(coalesce(title, 'Untitled'), 40) || '...' as preview from works"
        ),
        "run_log_lines": digest_q(
            "select article_no, subject, left(title, 40) || '...' as preview from articles"
        ),
        "summary_requests": digest_q(
            f"""select 'article' as tier, article_id as ref,
                  md5({filled(summaries.ARTICLE_REQUEST, title='title', abstract='abstract')})
                    as request_md5 from articles
                union all select 'domain', subject,
                  md5({filled(summaries.DOMAIN_REQUEST, subject='subject', context='context')})
                  from contexts
                union all select 'global', 'digest',
                  md5({filled(summaries.GLOBAL_REQUEST, context='context')}) from whole"""
        ),
        "summary_outcomes": q(
            "attempts",
            " union all ".join(
                outcome_select(name, tier)
                for name, tier in (
                    ("article", summaries.ARTICLE),
                    ("domain", summaries.DOMAIN),
                    ("global", summaries.GLOBAL),
                )
            ),
        ),
        "summarise_udf": q(
            "works",
            f"""select work_id,
                  cast(case when size is null then 0 when size % 7 = 0 then 3 else 1 end as bigint)
                    as attempts,
                  case when size is null then 'no_abstract' when size % 7 = 0 then 'exhausted'
                    when size % 7 = 1 then 'failed' when size % 7 = 2 then 'unlabelled' else 'ok' end
                    as status,
                  case when size is null then {lit(fixed.NO_ABSTRACT[0])}
                    when size % 7 = 0 then {lit(fixed.ARTICLE_EXHAUSTED[0])}
                    when size % 7 = 1 then {lit(fixed.ARTICLE_FAILED[0])}
                    else size || ' characters' end as en,
                  case when size is null then {lit(fixed.NO_ABSTRACT[1])}
                    when size % 7 = 0 then {lit(fixed.ARTICLE_EXHAUSTED[1])}
                    when size % 7 = 1 then {lit(fixed.ARTICLE_FAILED[1])}
                    when size % 7 = 2 then {lit(fixed.ARTICLE_UNLABELLED_HE)}
                    else cast(size as varchar) end as he
                from (select work_id, case when abstract is not null then length({REQUEST}) end as size
                      from works) w""",
        ),
        "summarise_ledger": q(
            "works",
            f"""select work_id,
                  cast(case when size is null then 0 when size % 7 = 0 then 3 else 1 end as bigint)
                    as attempts,
                  case when size is null then 'no_abstract' when size % 7 = 0 then 'exhausted'
                    when size % 7 = 1 then 'failed' when size % 7 = 2 then 'unlabelled' else 'ok' end
                    as status,
                  case when size is null then {lit(fixed.NO_ABSTRACT[0])}
                    when size % 7 = 0 then {lit(fixed.ARTICLE_EXHAUSTED[0])}
                    when size % 7 = 1 then {lit(fixed.ARTICLE_FAILED[0])}
                    else size || ' characters' end as en,
                  case when size is null then {lit(fixed.NO_ABSTRACT[1])}
                    when size % 7 = 0 then {lit(fixed.ARTICLE_EXHAUSTED[1])}
                    when size % 7 = 1 then {lit(fixed.ARTICLE_FAILED[1])}
                    when size % 7 = 2 then {lit(fixed.ARTICLE_UNLABELLED_HE)}
                    else cast(size as varchar) end as he
                from (select work_id, case when abstract is not null then length({REQUEST}) end as size
                      from works) w""",
        ),
        "digest_summarised": q(
            "works journals",
            f"""select 'article' as tier, article_id as ref, summary_en as en, summary_he as he
                from articles
                union all select 'domain', subject, {DOMAIN_ANSWER[0]}, {DOMAIN_ANSWER[1]} from contexts
                union all select 'global', 'digest', {GLOBAL_ANSWER[0]}, {GLOBAL_ANSWER[1]} from whole""",
            **SUMMARISED,
        ),
        "article_summaries": q(
            "works",
            f"select work_id, {SUMMARY_EN} as summary_en, {SUMMARY_HE} as summary_he from works",
        ),
        "domain_summaries": digest_q("select * from domains"),
        "global_briefing": digest_q("select * from briefing"),
        "stream_ingest": q(
            "works_big",
            """select issn, l_orderkey, l_linenumber, publication_date, cited_by_count from works_big""",
        ),
        "stream_ingest_pages": q(
            "works journals",
            """select id as work_id, subject, journal_name, coalesce(title, 'Untitled') as title,
                 publication_date, grade, cited_by_count as citations, coalesce(doi, id) as link
               from paged where status = 200""",
            paged=PAGED_WORKS_SQL,
        ),
        "stream_merge_pages": q(
            "works journals",
            """select id as work_id, subject, journal_name, coalesce(title, 'Untitled') as title,
                 publication_date, grade, cited_by_count as citations, coalesce(doi, id) as link,
                 date '2001-08-02' as pulled_on
               from paged where status = 200""",
            paged=PAGED_WORKS_SQL,
        ),
        "stream_dedup": "select distinct user_id, event_type, cast(ts as date) as day from events",
        "stream_weekly_counts": windows(WEEK),
        "stream_rolling_counts": windows(
            "date_trunc('day', ts) - to_days(cast(unnest(range(7)) as integer))"
        ),
        "stream_closed_windows": f"""
            select * from ({windows(WEEK)}) w
            where window_end <= (select max(ts) from events) - interval 1 day
        """,
        "stream_upsert": q(
            "works_big",
            """select issn, l_orderkey, l_linenumber, publication_date, cited_by_count from works_big
               qualify row_number() over (partition by l_orderkey, l_linenumber
                 order by publication_date desc, cited_by_count desc, issn) = 1""",
        ),
        "stream_enrich": q(
            "works_big journals_big",
            """select issn, l_orderkey, l_linenumber, publication_date, cited_by_count, subject, grade
               from works_big join journals_big using (issn)""",
        ),
    }
