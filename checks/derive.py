"""Captured-web tables derived from the given tables.

The given pages do not link to each other and bring no sitemaps, redirects, name
records or wiki replies, so these are computed from them, in one SQL text that
Spark and DuckDB both read. All work is row-wise or on groups bounded by
construction, and grows with the tables. A third of all pages belongs to one
site, and a third of all documents to one wiki.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from sitelode.sources.tables import read_table

# Pages placed on sites; idx numbers the pages of a site, and page 0 is its start page.
SITE_PAGES = """
select page_id, html, site, site_no, idx, fan, suffix, lang,
       'https://' || site || case when idx = 0 then '/docs/' else '/docs/' || lang || '/p' || cast(page_id as string) || suffix end as url,
       200 + case when idx > 0 and page_id % 11 = 5 then 204 else 0 end as status,
       case when idx > 0 and page_id % 13 = 6 then 'application/pdf' when page_id % 2 = 0 then 'text/html; charset=utf-8' else 'application/XHTML+xml' end as content_type,
       page_id % 17 = 8 as is_blank,
       100 + (page_id % 7) * 400 as elapsed_ms
from (select page_id, html,
             case when page_id % 3 = 0 then 'hub.example.com' else 's' || cast(cast(floor(page_id / 48.0) as bigint) as string) || '.example.org' end as site,
             case when page_id % 3 = 0 then 0 else cast(floor(page_id / 48.0) as bigint) + 1 end as site_no,
             cast(case when page_id % 3 = 0 then floor(page_id / 3.0) else page_id % 48 - floor((page_id % 48) / 3.0) - 1 end as bigint) as idx,
             case when page_id % 3 = 0 then 8 else 2 end as fan,
             regexp_extract(url, '^https?://[^/]+/[a-z]+/[0-9]+(.*)$', 1) as suffix,
             regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) as lang
      from $pages) placed
"""

# Each page is linked from its parent in a tree, under one of three spellings; some also without their slash.
SITE_CAPTURES = f"""
with u as ({SITE_PAGES}),
kids as (
  select site, cast(floor((idx - 1) / (fan * 1.0)) as bigint) as idx,
         AGG['<a href="' || replace(case when page_id % 5 = 0 then replace(url, 'https://' || site || '/docs/', '/docs/zz/.././')
                                         when page_id % 2 = 0 then replace(url, 'https://' || site, '') else url end, '&', '&amp;') || '"></a>'
             || case when page_id % 7 = 0 and suffix = '/' then '<a href=' || substr(url, 1, length(url) - 1) || '></a>' else '' end; page_id] as links
  from u where idx > 0 group by site, cast(floor((idx - 1) / (fan * 1.0)) as bigint))
select u.url, u.status, u.content_type,
       case when u.is_blank then '<html><body>' else u.html end || coalesce(kids.links, '')
         || '<a href="/docs/"></a><a href=''https://elsewhere.example.com/docs/x''></a><a href=/docs/f' || cast(u.page_id as string) || '.pdf></a>' as body,
       cast(null as string) as location, u.elapsed_ms
from u left join kids on u.site = kids.site and u.idx = kids.idx
"""

# One raw crawl request per site, with gaps, blanks and out-of-range numbers.
SITE_REQUESTS = f"""
select site as crawl_id,
       case when site_no % 2 = 1 then '  https://' || site || ' ' else 'https://' || site || '/docs/' end as url,
       case when site_no % 3 = 2 then true end as discover,
       case when site_no % 5 = 3 then ' /docs/en/ ' when site_no % 5 = 4 then '  ' end as path_prefix,
       case when site_no % 4 = 1 then 'HTML' when site_no % 4 = 2 then 'other' when site_no % 8 = 3 then 'MediaWiki' end as strategy,
       cast(null as string) as include_paths,
       case when site_no % 3 = 1 then 'docs/de/*, ,docs/es/p1*' when site_no % 3 = 2 then ' ' end as exclude_paths,
       cast(case when site_no = 0 then 200 when site_no % 3 = 1 then 5 when site_no % 3 = 2 then 30 else 0 end as int) as max_pages,
       cast(case when site_no % 4 = 1 then 0 when site_no % 4 = 2 then 2 when site_no % 4 = 3 then 3 end as int) as max_depth,
       cast(site_no % 40 - 3 as int) as max_concurrency, cast(site_no % 9 - 4 as int) as request_delay_ms
from (select distinct site, site_no from ({SITE_PAGES}) p) s
union all
select 'blank-' || cast(page_id as string), '   ', null, null, null, null, null, null, null, null, null from $pages where page_id % 100 = 7
"""

# Link starts as the traversal takes them, all from the start page.
SITE_STARTS = f"""
select site as crawl_id, 'https://' || site || '/docs/' as url,
       case when site_no % 5 = 3 then '/docs/en/' else '/docs/' end as path_prefix,
       site_no % 3 = 1 as excludes,
       cast(case when site_no = 0 then 200 when site_no % 3 = 1 then 5 else 30 end as int) as max_pages,
       cast(case when site_no % 4 = 2 then 2 when site_no % 4 = 3 then 3 else 5 end as int) as max_depth
from (select distinct site, site_no from ({SITE_PAGES}) p) s
"""

# Sites of 120 pages with sitemaps. Kind 0: robots names an index of 60 files; 1: one flat
# sitemap; 2: robots names a missing file, an empty one and a mixed index, twice.
MAP_SITES = """
select page_id, url as page_url, map_no, map_no % 3 as kind, idx, 'https://m' || cast(map_no as string) || '.example.net' as root,
       'https://m' || cast(map_no as string) || '.example.net/' || case when page_id % 2 = 0 then 'docs/' else 'blog/' end || 'a' || cast(page_id as string)
         || case when page_id % 5 = 0 then '.pdf' when page_id % 7 = 0 then '?x=1&amp;y=2' else '' end as loc
from (select page_id, url, cast(floor(page_id / 120.0) as bigint) as map_no, page_id % 120 as idx from $pages) m
"""

SITEMAP_CAPTURES = f"""
with m as ({MAP_SITES}),
subs as (select root, kind, cast(floor(idx / 2.0) as bigint) as sub, AGG['<url><loc> ' || loc || ' </loc></url>'; page_id] as locs
         from m group by root, kind, cast(floor(idx / 2.0) as bigint)),
roots as (select distinct root, kind from m)
select root || '/robots.txt' as url, 200 as status, 'text/plain' as content_type,
       case when kind = 0 then 'User-agent: *' || chr(13) || chr(10) || 'sitemap: ' || root || '/index.xml' || chr(13) || chr(10)
            else 'User-agent: *' || chr(10) || 'Sitemap:' || root || '/missing.xml' || chr(10) || '  SITEMAP: ' || root || '/empty.xml' || chr(10)
                 || 'Sitemap: ' || root || '/mixed.xml' || chr(10) || 'Sitemap: ' || root || '/empty.xml' || chr(10) end as body,
       cast(null as string) as location, 50 as elapsed_ms
from roots where kind <> 1
union all
select root || '/sub' || cast(sub as string) || '.XML', case when sub = 7 then 500 else 200 end, 'application/xml',
       '<urlset>' || locs || case when sub = 3 then '<url><loc>' || root || '/nested.xml</loc></url>' else '' end || '</urlset>', null, 50
from subs where kind <> 1
union all
select root || '/index.xml', 200, 'text/plain', chr(10) || ' <SitemapIndex>' || AGG['<sitemap><loc>' || root || '/sub' || cast(sub as string) || '.XML</loc></sitemap>'; sub] || '</SitemapIndex>', null, 50
from subs where kind = 0 group by root
union all
select root || '/mixed.xml', 200, 'text/xml', '<urlset><url><loc>' || root || '/docs/dropped</loc></url><url><loc>' || root || '/sub1.XML</loc></url></urlset>', null, 50
from subs where kind = 2 and sub = 1
union all
select root || '/empty.xml', 200, 'application/xml', '<urlset></urlset>', null, 50 from roots where kind = 2
union all
select root || '/sitemap.xml', 200, 'text/plain', '<?xml version="1.0"?><urlset>' || AGG['<url><loc>' || loc || '</loc></url>'; page_id] || '</urlset>', null, 50
from m group by root
"""

# Some of the pages that the sitemaps list were captured; entries keep their entities, and so do these URLs.
MAP_PAGES = f"""
select loc as url, 200 as status, 'text/html' as content_type, case when page_id % 8 = 2 then '<html><body>' else html end as body, cast(null as string) as location, 40 as elapsed_ms
from (select m.*, p.html from ({MAP_SITES}) m join $pages p on p.page_id = m.page_id) x where page_id % 9 <> 4
"""

# Docs roots: per page a bare or a deep URL; answers exist under some of the probed paths.
ROOT_CAPTURES = """
select root || case hop when 0 then '/doc/' when 1 then '/documentation/' when 2 then '/manual/' when 3 then '/wiki/' when 4 then '/en/docs/' else '/no-such-page-probe/' end as url,
       case when hop = 0 then 404 else 200 end as status,
       case when hop = 1 then 'application/json' else 'text/html' end as content_type,
       '<html>ok</html>' as body, cast(null as string) as location, 50 as elapsed_ms
from (select 'https://d' || cast(page_id as string) || '.example.com' as root, page_id from $pages) d EACH[0; 5]
where case hop when 0 then page_id % 2 = 0 when 1 then page_id % 3 = 0 when 2 then page_id % 2 = 1 when 3 then page_id % 3 = 1 when 4 then page_id % 5 = 2 else page_id % 7 = 3 end
"""

ROOT_BASES = """
select 'd' || cast(page_id as string) as crawl_id,
       'https://d' || cast(page_id as string) || '.example.com' || case when page_id % 4 = 1 then '/' when page_id % 4 = 2 then '/guide/x' else '' end as url
from $pages
"""

# Chains of 0 to 7 redirects per page; every third location is relative, and one in nine has none.
REDIRECT_CAPTURES = """
select 'https://r.example.com/' || cast(page_id as string) || '/' || cast(hop as string) as url,
       case when hop < page_id % 8 then 302 else 200 end as status, 'text/html' as content_type,
       case when hop < page_id % 8 then '' else html end as body,
       case when hop >= page_id % 8 then null when page_id % 9 = 4 and hop = 2 then null
            when page_id % 3 = 0 then '../' || cast(page_id as string) || '/' || cast(hop + 1 as string) || '#x'
            else 'https://r.example.com/' || cast(page_id as string) || '/' || cast(hop + 1 as string) end as location,
       10 as elapsed_ms
from $pages EACH[0; 7]
where hop <= page_id % 8
"""

# Name records of the pages' own hosts: one address per page.
ADDRESSES = """
select regexp_extract(url, '^https?://([^/:]+)', 1) as host, page_id,
       case when page_id % 10 = 9 then '2606:4700::' || cast(page_id % 1000 as string)
            when page_id % 50 = 18 then 'fd00::' || cast(page_id % 1000 as string)
            when page_id % 50 = 28 then '::ffff:10.0.0.' || cast(page_id % 256 as string)
            when page_id % 50 = 38 then 'not-an-address'
            else cast(page_id * 37 % 230 as string) || '.' || cast(page_id * 11 % 256 as string) || '.' || cast(page_id * 5 % 256 as string) || '.' || cast(page_id % 256 as string) end as ip
from $pages
"""

# Some names have no record.
DNS = f"select host, page_id, ip from ({ADDRESSES}) a where page_id % 4 <> 0"

# Captures of URLs that the address guard has to judge: other schemes, no host, literals of both kinds.
GUARDED_CAPTURES = """
select page_id, case page_id % 10 when 1 then regexp_replace(url, '^https?', 'ftp') when 2 then 'https:///nowhere' when 3 then 'http://10.1.2.3/x'
                     when 4 then 'http://u:p@[2606:4700::1]:80/x' when 5 then 'http://[::1]/x' when 6 then 'https://[FD00::1]:8443/x' else url end as url,
       200 as status, 'text/html' as content_type, html as body, cast(null as string) as location, 10 as elapsed_ms
from $pages
"""

# Documents as wiki articles: titles, listing batches of 20, site info and rendered articles.
WIKI_DOCS = """
select doc_id, text, wiki, wiki_no, idx, 'https://' || wiki || '/w/api.php' as api_url,
       upper(lang) || ' page ' || cast(doc_id as string) || case when doc_id % 5 = 0 then '/sub' when doc_id % 5 = 1 then ': note' when doc_id % 5 = 2 then ' ~*é' else '' end as title
from (select doc_id, text, lang,
             case when doc_id % 3 = 0 then 'hub.wiki.example' else 'w' || cast(cast(floor(doc_id / 150.0) as bigint) as string) || '.wiki.example' end as wiki,
             case when doc_id % 3 = 0 then 0 else cast(floor(doc_id / 150.0) as bigint) + 1 end as wiki_no,
             cast(case when doc_id % 3 = 0 then floor(doc_id / 3.0) else doc_id % 150 - floor((doc_id % 150) / 3.0) - 1 end as bigint) as idx
      from $documents) placed
"""

WIKI_SITES = f"""
select distinct wiki, wiki_no, api_url from ({WIKI_DOCS}) d
"""

_LISTING = "action=query&list=allpages&apnamespace=0&aplimit=20&format=json"

# Some wikis were also asked for five titles at a time; those replies lead nowhere.
WIKI_LISTINGS = f"""
with d as ({WIKI_DOCS}),
few as (select api_url, max(wiki_no) as wiki_no, count(*) as n, AGG[case when idx < 5 then '{{"pageid":' || cast(doc_id as string) || ',"title":"' || title || '"}}' else '' end; idx] as entries
        from d group by api_url),
b as (select api_url, wiki_no, cast(floor(idx / 20.0) as bigint) as batch, AGG['{{"pageid":' || cast(doc_id as string) || ',"title":"' || title || '"}}'; idx] as entries
      from d group by api_url, wiki_no, cast(floor(idx / 20.0) as bigint))
select b.api_url || '?{_LISTING}' || case when b.batch > 0 then '&apcontinue=B+' || cast(b.batch as string) || '&continue=-%7C%7C' else '' end as url,
       case when b.wiki_no % 5 = 4 and b.batch = 1 then 503 else 200 end as status, 'application/json' as content_type,
       '{{' || case when n.batch is null then '' else '"continue":{{"continue":"-||","apcontinue":"B ' || cast(n.batch as string) || '"}},' end
         || '"query":{{"allpages":[' || replace(b.entries, '}}{{', '}},{{') || ']}}}}' as body,
       cast(null as string) as location, 20 as elapsed_ms
from b left join b n on n.api_url = b.api_url and n.batch = b.batch + 1
union all
select api_url || '?' || replace('{_LISTING}', '=20', '=5'), 200, 'application/json',
       '{{' || case when n > 5 then '"continue":{{"continue":"-||","apcontinue":"F 5"}},' else '' end
         || '"query":{{"allpages":[' || replace(entries, '}}{{', '}},{{') || ']}}}}', cast(null as string), 20
from few where wiki_no % 2 = 1
"""

WIKI_SITEINFO = f"""
select api_url || '?action=query&meta=siteinfo&siprop=general&format=json' as url, case when wiki_no % 11 = 6 then 404 else 200 end as status,
       'application/json' as content_type,
       case when wiki_no % 11 = 7 then '<html>' else
       '{{"query":{{"general":{{"generator":"' || case when wiki_no % 7 = 5 then 'OtherCMS 2' else 'MediaWiki 1.4' || cast(wiki_no % 10 as string) end || '"'
         || case when wiki_no % 4 = 1 then ',"server":""' when wiki_no % 4 = 2 then ',"server":"//' || wiki || '"' else ',"server":"https://' || wiki || '/"' end
         || case when wiki_no % 3 = 1 then '' else ',"articlepath":"/wiki/$1"' end || '}}}}}}' end as body,
       cast(null as string) as location, 20 as elapsed_ms
from ({WIKI_SITES}) s
"""

# Entry pages advertise the endpoint with their attributes in either order.
WIKI_FRONTS = f"""
select 'https://' || wiki || '/' as url, 200 as status, 'text/html' as content_type,
       case when wiki_no % 2 = 0 then '<head><link rel="stylesheet" href="/x.css"><link rel="EditURI" type="application/rsd+xml" href="//' || wiki || '/w/api.php?action=rsd"/></head>'
            else '<LINK href=''/w/api.php?action=rsd#x'' rel=EditURI>' end as body,
       cast(null as string) as location, 20 as elapsed_ms
from ({WIKI_SITES}) s
"""

_JSON_TEXT = "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '\"', '&quot;'), chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n')"

WIKI_ALL_ARTICLES = f"""
select doc_id, api_url || '?action=parse&page=' || replace(replace(replace(replace(replace(replace(title, ' ', '+'), '/', '%2F'), ':', '%3A'), '*', '%2A'), 'é', '%C3%A9'), '$', '%24') || '&prop=text&formatversion=2&format=json' as url,
       200 as status, 'application/json' as content_type,
       '{{"parse":{{"title":"x","text":' || case when doc_id % 2 = 0 then '{{"*":' else '' end
         || '"<div class=' || chr(92) || '"mw-parser-output' || chr(92) || '"><h2>Text<span class=mw-editsection>[<a>edit</a>]</span></h2><table class=''x infobox''><tr><td><b>noise</b></td></tr></table><p>'
         || {_JSON_TEXT.format('text')} || '</p><style>p</style></div>"' || case when doc_id % 2 = 0 then '}}' else '' end || '}}}}' as body,
       cast(null as string) as location, 30 as elapsed_ms
from ({WIKI_DOCS}) d
"""

# Some articles were not captured.
WIKI_ARTICLES = f"select url, status, content_type, body, location, elapsed_ms from ({WIKI_ALL_ARTICLES}) every_article where doc_id % 19 <> 11"

WIKI_CAPTURES = f"""
{WIKI_LISTINGS}
union all select url, status, content_type, body, location, elapsed_ms from ({WIKI_SITEINFO}) i
union all select url, status, content_type, body, location, elapsed_ms from ({WIKI_FRONTS}) f
union all select url, status, content_type, body, location, elapsed_ms from ({WIKI_ARTICLES}) a
"""

WIKI_BASES = f"""
select wiki as crawl_id, case when wiki_no % 3 = 2 then api_url || '?x=1' else 'https://' || wiki || '/' end as url,
       cast(case when wiki_no = 0 then 1000 when wiki_no % 2 = 0 then 30 else 500 end as int) as max_pages
from ({WIKI_SITES}) s
"""

# Captures of several days: some pages were captured again, with another body or another fragment.
REPEATED_CAPTURES = f"""
select url, status, content_type, body, location, elapsed_ms from ({SITE_CAPTURES}) s
union all select regexp_replace(url, '#.*$', '') || '#again', status, content_type, '<p>older</p>' || body, location, elapsed_ms + 1 from ({SITE_CAPTURES}) o where elapsed_ms % 3 = 1
union all select url, status, content_type, body, location, elapsed_ms from ({SITE_CAPTURES}) e where elapsed_ms % 5 = 0
"""

# Captures with the second they came in; some pages came again later or earlier, under another spelling and with another body.
ARRIVING_CAPTURES = f"""
select url, status, content_type, body, elapsed_ms, page_id * 7 % 1000 as second from (select c.*, p.page_id from ({SITE_CAPTURES}) c join ({SITE_PAGES}) p on p.url = c.url) s
union all
select replace(url, 'https://', 'HTTPS://') || case when instr(url, '#') > 0 then '' else '#again' end, status, content_type, html, elapsed_ms, (page_id * 7 + page_id % 3 - 1) % 1000
from ({SITE_PAGES}) p where page_id % 4 = 1 and not is_blank
"""

# Fetch logs of crawls, for caps and progress: every page is one visit.
FETCH_LOG = f"""
select site as crawl_id, idx as visit, status = 200 and not is_blank as has_content, cast(elapsed_ms as bigint) as elapsed_ms,
       cast(case when site_no = 0 then 300 when site_no % 2 = 0 then 10 else 50 end as bigint) as max_pages,
       case when site_no % 3 = 0 then cast(null as bigint) else cast(40 as bigint) end as source_total
from ({SITE_PAGES}) p
"""


def for_spark(text: str) -> str:
    listed = re.sub(r"AGG\[(.*?); (\w+)\]", r"listagg(\1, '') within group (order by \2)", text, flags=re.S)
    listed = re.sub(r"EACH\[(\d+); (\d+)\]", r"lateral view explode(sequence(\1, \2)) numbers as hop", listed)
    return listed.replace("$pages", "src_pages").replace("$documents", "src_documents")


def for_duckdb(text: str) -> str:
    listed = re.sub(r"AGG\[(.*?); (\w+)\]", r"string_agg(\1, '' order by \2)", text, flags=re.S)
    listed = re.sub(r"EACH\[(\d+); (\d+)\]", r", unnest(generate_series(\1, \2)) as numbers(hop)", listed)
    return listed.replace("$pages", "pages").replace("$documents", "documents")


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """One derived table over the tables in ``sf_dir``."""
    for name in ("pages", "documents"):
        if f"${name}" in text:
            read_table(spark, f"{sf_dir}/{name}.parquet").createOrReplaceTempView(f"src_{name}")
    return spark.sql(for_spark(text))
