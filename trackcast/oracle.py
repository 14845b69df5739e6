"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string is self-contained: the mapping views are inlined as CTEs over the
base tables.  The SQL follows the original application's formulation (e.g.
the term average over the exploded term x song join, the similar-artist
counts over the pair table), so it cross-checks the re-planned Spark jobs.
Reported doubles are rounded the same way on both sides (half-up after
snapping to 9 decimals).
"""

from __future__ import annotations


def R(expr: str, digits: int = 6) -> str:
    return (f"case when abs({expr}) < 1e28 then cast(round(try_cast({expr} as decimal(38,9)), {digits}) as double) "
            f"else cast({expr} as double) end")


def clean(expr: str) -> str:
    return f"lower(regexp_replace({expr}, '[^A-Za-z0-9]', '', 'g'))"


def num(expr: str) -> str:
    """Parse as double, NaN as missing."""
    return f"(case when isnan(try_cast({expr} as double)) then null else try_cast({expr} as double) end)"


def zero(expr: str) -> str:
    return f"coalesce({num(expr)}, 0.0)"


CONFIDENCE_CASE = ("case {c} when 'terrible' then 0 when 'poor' then 1 when 'average' then 2 "
                   "when 'good' then 3 when 'very good' then 4 when 'excellent' then 5 else -1 end")


def confidence(expr: str) -> str:
    return CONFIDENCE_CASE.format(c=expr)


# ------------------------------------------------------------------ mapping views
V_SONG_INFO = """song_info as (
  select cast(l.l_partkey as varchar) song_id,
         cast(l.l_suppkey as varchar) || '-' || cast(l.l_partkey as varchar) track_id,
         cast(l.l_suppkey as varchar) artist_id, s.s_name artist_name, p.p_name title,
         round(s.s_acctbal * 100) artist_hotttnesss, s.s_acctbal / 10000 artist_familiarity,
         p.p_size * cast(-0.5 as double) loudness, p.p_size * cast(3 as double) tempo,
         p.p_retailprice duration,
         case when p.p_size % 7 = 0 then 'NA' else cast(p.p_size as varchar) end song_hotttnesss,
         cast(l.year as integer) as year
  from (select l_partkey, l_suppkey, year(min(l_shipdate)) as year
        from lineitem group by l_partkey, l_suppkey) l
  join part p on l.l_partkey = p.p_partkey
  join supplier s on l.l_suppkey = s.s_suppkey)"""

V_PLAY_COUNT = """play_count as (
  select cast(l_partkey as varchar) play_song_id,
         cast(l_suppkey as varchar) || '-' || cast(l_partkey as varchar) play_track_id,
         count(*) play_count
  from lineitem where l_returnflag = 'R' group by l_partkey, l_suppkey)"""

V_SIMILAR = """similar_artists as (
  select cast(a.l_suppkey as varchar) artist_id, cast(b.l_suppkey as varchar) similar_artist
  from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and b.l_linenumber = a.l_linenumber + 1
  where a.l_suppkey % 7 <> 0)"""

V_TERMS = """artist_terms as (
  select cast(l_suppkey as varchar) artist_id, p_brand || ' ' || p_type || ' ' || cast(p_size as varchar) artist_term,
         l_discount weight, l_quantity freq
  from lineitem join part on l_partkey = p_partkey
  where l_suppkey % 11 <> 0)"""

V_LIKES = """track_likes as (
  select cast(user_id % 10 as varchar) || '-' || cast(user_id as varchar) track, count(*) likes
  from events where event_type = 'click' group by user_id)"""

V_DOWNLOADS = """downloads as (
  select s_name artist, p_name title, avg(l_extendedprice) mean_price, sum(l_quantity) downloads,
         case substr(min(o_orderpriority), 1, 1) when '1' then 'excellent' when '2' then 'very good'
              when '3' then 'good' when '4' then 'average' else 'unrated' end confidence
  from lineitem
  join supplier on l_suppkey = s_suppkey
  join part on l_partkey = p_partkey
  join orders on l_orderkey = o_orderkey
  where l_returnflag = 'A'
  group by s_name, p_name)"""

V_REQUESTS = """requests as (
  select l_suppkey || '-' || l_partkey request_id,
         case when (l_partkey + l_suppkey) % 4 < 2 then s_name else 'nobody ' || l_suppkey || '-' || l_partkey end artist,
         case when (l_partkey + l_suppkey) % 2 = 0 then p_name else 'nothing ' || l_suppkey || '-' || l_partkey end title
  from (select distinct l_partkey, l_suppkey from lineitem)
  join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey)"""

# ------------------------------------------------------------------ cleaned tables
V_SONG_CLEAN = f"""song_clean as (
  select {clean('artist_name')} artist_name, {clean('title')} title,
         {zero('song_hotttnesss')} song_hotness, {zero('artist_hotttnesss')} artist_hotness,
         {zero('tempo')} tempo, artist_id, song_id, track_id
  from song_info)"""

V_SONG_WIDE = f"""song_wide as (
  select song_id, track_id, artist_id, {clean('lower(artist_name)')} artist_name,
         {clean('lower(title)')} title,
         {zero('artist_hotttnesss')} artist_hotttnesss, {zero('artist_familiarity')} artist_familiarity,
         {zero('loudness')} loudness, {zero('tempo')} tempo, {zero('duration')} duration,
         {zero('song_hotttnesss')} song_hotttnesss, try_cast(year as integer) as year
  from song_info)"""

def v_td(name: str, require: str) -> str:
    return f"""{name} as (
  select {clean('artist')} td_artist, {clean('title')} td_title,
         {num('mean_price')} td_meanPrice, {num('downloads')} td_downloads,
         {confidence('confidence')} td_confidence
  from downloads where {num(require)} is not null)"""


V_TD = v_td("td", "mean_price")            # of the lookup table
V_TD_LABEL = v_td("td_label", "downloads")  # of the training matrix

V_SIM_COUNT = """sim as (
  select artist_id, count(similar_artist) similar_artist_count
  from similar_artists group by artist_id)"""


def v_top(name: str, songs: str, hot: str, k: int) -> str:
    """Top-k terms by average hotness over the term x song join (ties by term)."""
    return f"""{name}_hot as (
  select t.artist_term, avg({hot}) artist_hotness
  from artist_terms t join {songs} s on t.artist_id = s.artist_id
  group by t.artist_term),
{name} as (
  select artist_term, artist_hotness from {name}_hot
  order by artist_hotness desc nulls last, artist_term limit {k})"""


def v_overlap(name: str, top: str, col: str) -> str:
    return f"""{name} as (
  select t.artist_id,
         cast(count(distinct case when x.artist_term is not null then t.artist_term end) as integer) {col}
  from artist_terms t left join {top} x on t.artist_term = x.artist_term
  group by t.artist_id)"""


V_WDF = f"""wdf as (
  select artist_id, sum({num('weight')} * {num('freq')}) weight_dot_freq
  from artist_terms where {num('weight')} is not null and {num('freq')} is not null
  group by artist_id)"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


# L2 chain up to the song-level intermediate (q4) and the lookup table.
LOOKUP_CTES = [
    V_SONG_INFO, V_PLAY_COUNT, V_SIMILAR, V_TERMS, V_DOWNLOADS, V_SONG_CLEAN, V_TD, V_SIM_COUNT,
    v_top("top_f", "song_clean", "s.artist_hotness", 1000),
    v_overlap("overlap_f", "top_f", "top_1000_count"),
    """q1 as (
  select s.artist_id, s.artist_name, s.title, s.song_hotness, s.artist_hotness, s.tempo,
         coalesce(p.play_count, 0) play_count, s.song_id
  from song_clean s left join play_count p on s.song_id = p.play_song_id and s.track_id = p.play_track_id)""",
    """q2 as (
  select q1.*, coalesce(sim.similar_artist_count, 0) similar_artist_count
  from q1 left join sim on q1.artist_id = sim.artist_id)""",
    """q4 as (
  select q2.*, o.top_1000_count from q2 join overlap_f o on q2.artist_id = o.artist_id)""",
    """features as (
  select q4.artist_name, q4.title, coalesce(td.td_confidence, 0) td_confidence,
         q4.artist_hotness, q4.song_hotness, coalesce(td.td_meanPrice, 0.0) td_meanPrice
  from q4 left join td on q4.title = td.td_title and q4.artist_name = td.td_artist)""",
]


def ctes(*groups) -> str:
    """``with`` clause from CTE lists, each CTE once, first occurrence wins."""
    seen, out = set(), []
    for group in groups:
        for c in (group if isinstance(group, (list, tuple)) else [group]):
            if c not in seen:
                seen.add(c)
                out.append(c)
    return with_(*out)


def rcols(cols: str, digits: int = 6, **per: int) -> str:
    """Rounded select list for comma-separated double columns."""
    out = []
    for c in [x.strip() for x in cols.split(",") if x.strip()]:
        out.append(f"{R(c, per.get(c, digits))} {c}")
    return ", ".join(out)


# L3 chain (wide songs, plays, song count, term sums, similar, likes, overlap, training join).
EXPLORE_CTES = [
    V_SONG_INFO, V_PLAY_COUNT, V_SIMILAR, V_TERMS, V_LIKES, V_DOWNLOADS, V_SONG_WIDE, V_TD_LABEL,
    V_SIM_COUNT, V_WDF,
    v_top("top_e", "song_info", num("s.artist_hotttnesss"), 1000),
    v_overlap("overlap_e", "top_e", "top_50_count"),
    """sc as (select artist_id, count(song_id) song_count from song_wide group by artist_id)""",
    """e1 as (
  select w.*, coalesce(p.play_count, 0) play_count
  from song_wide w left join play_count p on w.song_id = p.play_song_id and w.track_id = p.play_track_id)""",
    """e2 as (select e1.*, sc.song_count from e1 join sc on e1.artist_id = sc.artist_id)""",
    """e3 as (
  select e2.*, coalesce(wdf.weight_dot_freq, 0.0) weight_dot_freq
  from e2 left join wdf on e2.artist_id = wdf.artist_id)""",
    """e4 as (
  select e3.*, coalesce(sim.similar_artist_count, 0) similar_artist_count
  from e3 left join sim on e3.artist_id = sim.artist_id)""",
    """e5 as (
  select e4.*, coalesce(l.likes, 0) likes from e4 left join track_likes l on e4.track_id = l.track)""",
    """e6 as (select e5.*, o.top_50_count from e5 join overlap_e o on e5.artist_id = o.artist_id)""",
    """m as (
  select td.td_confidence, e6.artist_hotttnesss, e6.artist_familiarity, e6.loudness, e6.tempo,
         e6.duration, e6.song_hotttnesss, e6.year, e6.play_count, e6.song_count, e6.weight_dot_freq,
         e6.similar_artist_count, e6.likes, td.td_meanPrice, e6.top_50_count,
         log10(greatest(e6.artist_familiarity * e6.song_count * e6.similar_artist_count, 0) + 1) popularity,
         td.td_downloads, td.td_artist
  from td_label td join e6 on td.td_title = e6.title and td.td_artist = e6.artist_name
  where td.td_artist <> '')""",
]

MATRIX_COLS = ("td_confidence, artist_hotttnesss, artist_familiarity, loudness, tempo, duration, "
               "song_hotttnesss, year, play_count, song_count, weight_dot_freq, similar_artist_count, "
               "likes, td_meanPrice, top_50_count, popularity, td_downloads")
MATRIX_DOUBLES = ("artist_hotttnesss, artist_familiarity, loudness, tempo, duration, song_hotttnesss, "
                  "weight_dot_freq, td_meanPrice, popularity, td_downloads")
MATRIX_OTHERS = "td_confidence, year, play_count, song_count, similar_artist_count, likes, top_50_count"


def matrix_select(where: str = "") -> str:
    return (f"select {MATRIX_OTHERS}, {rcols(MATRIX_DOUBLES, td_meanPrice=4)} from m "
            + (f"where {where}" if where else ""))


SQL: dict[str, str] = {}

# ------------------------------------------------------------------ sources / sinks
SONG_INFO_SELECT = (f"select song_id, track_id, artist_id, artist_name, title, "
                    f"{rcols('artist_hotttnesss, artist_familiarity, loudness, tempo, duration')}, "
                    f"song_hotttnesss, year from song_info")
SQL["read_delimited"] = ctes(V_SONG_INFO) + SONG_INFO_SELECT
SQL["read_headerless"] = ctes(V_LIKES) + "select track, likes from track_likes"
DOWNLOADS_SELECT = (f"select artist, title, {R('mean_price', 4)} mean_price, {R('downloads')} downloads, "
                    f"confidence from downloads")
SQL["read_split_lines"] = ctes(V_DOWNLOADS) + DOWNLOADS_SELECT
SQL["filter_field_count"] = ctes(V_DOWNLOADS) + DOWNLOADS_SELECT
SQL["parse_requests"] = ctes(V_REQUESTS) + "select artist, title from requests"
SQL["training_matrix"] = ctes(EXPLORE_CTES) + matrix_select()
SQL["roundtrip_parquet"] = SQL["training_matrix"]
LOOKUP_SELECT = f"""select artist_name, title, td_confidence,
       {R('artist_hotness')} artist_hotness, {R('song_hotness')} song_hotness,
       {R('td_meanPrice', 4)} td_meanPrice
from features"""
SQL["lookup_features"] = ctes(LOOKUP_CTES) + LOOKUP_SELECT
SQL["read_gzip_features"] = SQL["lookup_features"]
SQL["write_features_csv"] = SQL["lookup_features"]
SQL["global_averages"] = ctes(LOOKUP_CTES) + f"""select 3 mean_confidence,
       {R('avg(artist_hotness)', 4)} mean_artist_hotness,
       {R('avg(song_hotness)', 4)} mean_song_hotness,
       {R('avg(td_meanPrice)', 4)} mean_mean_price
from features"""
SQL["stage_row_counts"] = ctes(LOOKUP_CTES, EXPLORE_CTES, V_LIKES) + "\n union all ".join(
    f"select '{stage}' stage, count(*) n_rows from {table}" for stage, table in [
        ("song_info", "song_info"), ("play_count", "play_count"), ("similar_artist_count", "sim"),
        ("artist_terms", "artist_terms"), ("track_likes", "track_likes"), ("downloads", "downloads"),
        ("clean_downloads", "td"), ("lookup_features", "features"), ("training_matrix", "m")])

# ------------------------------------------------------------------ cleaning / scalars
SQL["project_song_info"] = ctes(V_SONG_INFO) + (
    f"select artist_name, title, song_hotttnesss as song_hotness, {R('artist_hotttnesss')} artist_hotness, "
    f"{R('tempo')} tempo, artist_id, song_id, track_id from song_info")
SQL["filter_numeric"] = ctes(V_SONG_INFO) + (
    f"select song_id, track_id, {R(num('song_hotttnesss'))} song_hotness from song_info "
    f"where {num('song_hotttnesss')} is not null")
SQL["clean_string"] = ctes(V_SONG_INFO) + (
    f"select song_id, track_id, {clean('artist_name')} artist_clean, {clean('title')} title_clean, "
    f"lower(artist_name) artist_lower from song_info")
SQL["is_all_digits"] = ctes(V_SONG_INFO) + (
    r"select song_id, track_id, regexp_full_match(song_id, '\p{Nd}*') song_id_digits, "
    r"regexp_full_match(track_id, '\p{Nd}*') track_id_digits, "
    r"regexp_full_match(song_hotttnesss, '\p{Nd}*') hotness_digits from song_info")
SQL["na_to_zero"] = ctes(V_SONG_INFO) + (
    f"select song_id, track_id, song_hotttnesss, {zero('song_hotttnesss')} song_hotness from song_info")
SQL["clean_song_info"] = ctes(V_SONG_INFO, V_SONG_CLEAN) + (
    f"select artist_name, title, {rcols('song_hotness, artist_hotness, tempo')}, artist_id, song_id, "
    f"track_id from song_clean")
SQL["clean_song_info_wide"] = ctes(V_SONG_INFO, V_SONG_WIDE) + (
    f"select song_id, track_id, artist_id, artist_name, title, "
    f"{rcols('artist_hotttnesss, artist_familiarity, loudness, tempo, duration, song_hotttnesss')}, "
    f"year from song_wide")
SQL["translate_confidence"] = ctes(V_DOWNLOADS) + (
    f"select artist, title, confidence, {confidence('confidence')} td_confidence from downloads")
SQL["clean_downloads"] = ctes(V_DOWNLOADS, V_TD) + (
    f"select td_artist, td_title, {R('td_meanPrice', 4)} td_meanPrice, {R('td_downloads')} td_downloads, "
    f"td_confidence from td")
SQL["popularity"] = ctes(EXPLORE_CTES) + (
    f"select td_artist, {R('artist_familiarity')} artist_familiarity, song_count, similar_artist_count, "
    f"{R('popularity')} popularity from m")
LN_POP = ("case when similar_artist_count * artist_familiarity * song_count + 1 > 0 "
          "then ln(similar_artist_count * artist_familiarity * song_count + 1) end")
SQL["popularity_ln"] = ctes(EXPLORE_CTES) + (
    f"select td_artist, {R('artist_familiarity')} artist_familiarity, song_count, similar_artist_count, "
    f"{R(LN_POP)} popularity from m")

# ------------------------------------------------------------------ aggregates / terms
SQL["song_count"] = ctes(V_SONG_INFO, V_SONG_WIDE) + (
    "select artist_id, count(song_id) song_count from song_wide group by artist_id")
SQL["similar_artist_count"] = ctes(V_SIMILAR, V_SIM_COUNT) + (
    "select artist_id, similar_artist_count from sim")
SQL["weight_dot_freq"] = ctes(V_TERMS, V_WDF) + f"select artist_id, {R('weight_dot_freq')} weight_dot_freq from wdf"
TOP_T = v_top("top_t", "song_clean", "s.artist_hotness", 1000)
SQL["top_terms"] = ctes(V_SONG_INFO, V_TERMS, V_SONG_CLEAN, TOP_T) + (
    f"select artist_term, {R('artist_hotness', 4)} artist_hotness from top_t")
SQL["genre_overlap"] = ctes(V_SONG_INFO, V_TERMS, V_SONG_CLEAN, TOP_T,
                            v_overlap("ov", "top_t", "top_term_count")) + (
    "select artist_id, top_term_count from ov")
SQL["genre_overlap_skip_na"] = ctes(V_SONG_INFO, V_TERMS,
                                    v_top("top_r", "song_info", num("s.artist_hotttnesss"), 1000),
                                    v_overlap("ov", "top_r", "top_term_count")) + (
    "select artist_id, top_term_count from ov")

# ------------------------------------------------------------------ join stages
SQL["join_play_count"] = ctes(LOOKUP_CTES) + (
    f"select artist_id, artist_name, title, {rcols('song_hotness, artist_hotness, tempo')}, play_count, "
    f"song_id from q1")
SQL["join_similar_count"] = ctes(LOOKUP_CTES) + (
    f"select artist_id, artist_name, title, {rcols('song_hotness, artist_hotness, tempo')}, play_count, "
    f"song_id, similar_artist_count from q2")
SQL["join_genre_overlap"] = ctes(LOOKUP_CTES) + (
    f"select artist_id, artist_name, title, {rcols('song_hotness, artist_hotness, tempo')}, play_count, "
    f"song_id, similar_artist_count, top_1000_count from q4")
WIDE_SELECT = (f"song_id, track_id, artist_id, artist_name, title, "
               f"{rcols('artist_hotttnesss, artist_familiarity, loudness, tempo, duration, song_hotttnesss')}, "
               f"year, play_count")
SQL["join_song_count"] = ctes(EXPLORE_CTES) + f"select {WIDE_SELECT}, song_count from e2"
SQL["join_weight_dot_freq"] = ctes(EXPLORE_CTES) + (
    f"select {WIDE_SELECT}, song_count, {R('weight_dot_freq')} weight_dot_freq from e3")
SQL["join_likes"] = ctes(EXPLORE_CTES) + (
    f"select {WIDE_SELECT}, song_count, {R('weight_dot_freq')} weight_dot_freq, similar_artist_count, "
    f"likes from e5")
SQL["fill_missing"] = ctes(EXPLORE_CTES) + (
    f"select {WIDE_SELECT}, song_count, {R('weight_dot_freq')} weight_dot_freq, similar_artist_count, "
    f"likes, top_50_count from e6")

# ------------------------------------------------------------------ feature tables
SQL["filter_confidence"] = ctes(EXPLORE_CTES) + matrix_select("td_confidence > 1")
SQL["select_feature_subset"] = ctes(EXPLORE_CTES) + (
    f"select td_confidence, {rcols('artist_hotttnesss, song_hotttnesss, td_meanPrice, td_downloads', td_meanPrice=4)} from m")

# ------------------------------------------------------------------ lookups
def _stats(name: str, keys: str) -> str:
    return f"""{name} as (
  select {keys}, count(*) n_matches,
         case when count(*) = 1 then min(td_confidence) else 3 end td_confidence,
         avg(artist_hotness) artist_hotness, avg(song_hotness) song_hotness, avg(td_meanPrice) td_meanPrice
  from features group by {keys})"""


LOOKUP_LEVEL_CTES = LOOKUP_CTES + [
    V_REQUESTS,
    f"req as (select request_id, artist, title, {clean('artist')} artist_key, {clean('title')} title_key from requests)",
    _stats("st_exact", "artist_name, title"), _stats("st_artist", "artist_name"), _stats("st_title", "title"),
    """glob_avg as (select 3 td_confidence, avg(artist_hotness) artist_hotness, avg(song_hotness) song_hotness,
         avg(td_meanPrice) td_meanPrice from features)""",
]
STATS_SELECT = (f"r.request_id, r.artist_key, r.title_key, s.n_matches, s.td_confidence, "
                f"{R('s.artist_hotness', 4)} artist_hotness, {R('s.song_hotness', 4)} song_hotness, "
                f"{R('s.td_meanPrice', 4)} td_meanPrice")
SQL["lookup_exact"] = ctes(LOOKUP_LEVEL_CTES) + (
    f"select {STATS_SELECT} from req r join st_exact s on r.artist_key = s.artist_name and r.title_key = s.title")
SQL["lookup_artist"] = ctes(LOOKUP_LEVEL_CTES) + (
    f"select {STATS_SELECT} from req r join st_artist s on r.artist_key = s.artist_name")
SQL["lookup_title"] = ctes(LOOKUP_LEVEL_CTES) + (
    f"select {STATS_SELECT} from req r join st_title s on r.title_key = s.title")


def _pick(c: str) -> str:
    return (f"case when e.n_matches is not null then e.{c} when a.n_matches is not null then a.{c} "
            f"when t.n_matches is not null then t.{c} else g.{c} end")


SQL["resolve_features"] = ctes(LOOKUP_LEVEL_CTES) + f"""select r.request_id, r.artist, r.title,
  case when e.n_matches is not null then 'exact' when a.n_matches is not null then 'artist'
       when t.n_matches is not null then 'title' else 'global' end match_level,
  {_pick('td_confidence')} td_confidence,
  {R(_pick('artist_hotness'), 4)} artist_hotness, {R(_pick('song_hotness'), 4)} song_hotness,
  {R(_pick('td_meanPrice'), 4)} td_meanPrice
from req r
left join st_exact e on r.artist_key = e.artist_name and r.title_key = e.title
left join st_artist a on r.artist_key = a.artist_name
left join st_title t on r.title_key = t.title
cross join glob_avg g"""

# ------------------------------------------------------------------ report
PROFILE_COLUMNS = ("artist_hotttnesss", "artist_familiarity", "loudness", "tempo", "duration",
                   "song_hotttnesss", "year", "play_count", "song_count", "weight_dot_freq",
                   "similar_artist_count", "likes", "td_meanPrice", "td_confidence", "top_50_count",
                   "popularity")
REPORT_CTES = EXPLORE_CTES + [
    "rp as (select * from m where td_confidence > 1)",
    f"rp_ln as (select * replace ({LN_POP} as popularity) from rp)",
]
SQL["column_profile"] = ctes(REPORT_CTES) + "\n union all ".join(
    f"select '{c}' column_name, {R(f'avg(cast({c} as double))', 4)} mean, "
    f"{R(f'cast(median(cast({c} as double)) as double)', 4)} median from rp" for c in PROFILE_COLUMNS)


def _r(c: str) -> str:
    x = f"case when {c} is not null and td_downloads is not null then cast({c} as double) end"
    y = f"case when {c} is not null and td_downloads is not null then cast(td_downloads as double) end"
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"


SQL["download_correlations"] = ctes(REPORT_CTES) + "\n union all ".join(
    f"select '{c}' column_name, {R(_r(c))} r from rp_ln" for c in PROFILE_COLUMNS)


def _bin(v: str, lo: str, hi: str, bins: int = 20) -> str:
    return (f"cast(case when {hi} - {lo} = 0 then 0 "
            f"else least(floor(({v} - {lo}) / ({hi} - {lo}) * {bins}), {bins - 1}) end as integer)")


SQL["density_2d"] = ctes(REPORT_CTES, "long as (" + "\n union all ".join(
    f"select '{c}' column_name, cast({c} as double) x, cast(td_downloads as double) y from rp_ln "
    f"where isfinite(cast({c} as double)) and isfinite(cast(td_downloads as double))"
    for c in PROFILE_COLUMNS) + ")",
    """ranges as (select column_name, min(x) x_min, max(x) x_max, min(y) y_min, max(y) y_max
  from long group by column_name)""") + f"""select l.column_name, {_bin('l.x', 'r.x_min', 'r.x_max')} x_bin,
  {_bin('l.y', 'r.y_min', 'r.y_max')} y_bin, count(*) n_rows
from long l join ranges r on l.column_name = r.column_name
group by 1, 2, 3"""

# ------------------------------------------------------------------ split / baseline model
BUCKET = "(cast('0x' || substr(md5(td_artist), 1, 4) as integer) % 100)"
SPLIT_CTES = EXPLORE_CTES + [
    f"sp as (select *, case when {BUCKET} < 80 then 'train' else 'test' end split from m)",
    """br as (select td_confidence, avg(td_downloads) p from sp where split = 'train' group by td_confidence)""",
    """ov_mean as (select avg(td_downloads) p from sp where split = 'train')""",
    """pred as (
  select case when split = 'test' then 'testing data' else 'training data' end set_name,
         cast(td_downloads as double) label, coalesce(br.p, ov_mean.p) prediction
  from sp left join br on sp.td_confidence = br.td_confidence cross join ov_mean)""",
    """agg as (
  select set_name, avg(power(label - prediction, 2)) mse, avg(abs(label - prediction)) mae,
         var_pop(label) vy, var_pop(prediction) vp, avg(label) my, avg(prediction) mp
  from pred group by set_name)""",
]
SQL["artist_split"] = ctes(SPLIT_CTES) + (
    f"select td_artist, {BUCKET} artist_bucket, split, count(*) n_rows from sp group by 1, 2, 3")
SQL["regression_metrics"] = ctes(SPLIT_CTES) + "\n union all ".join(
    f"select set_name, '{name}' metric, {R(expr)} value from agg" for name, expr in [
        ("test_mean_squared_error", "mse"), ("mse", "mse"), ("rmse", "sqrt(mse)"),
        ("r2", "1 - mse / nullif(vy, 0)"), ("mae", "mae"),
        ("explained_variance", "vp + power(mp - my, 2)")])
SQL["actual_vs_predicted"] = ctes(SPLIT_CTES) + (
    "select cast(trunc(label) as integer) actual, cast(trunc(prediction) as integer) predicted, "
    "cast(abs(cast(trunc(label) as integer) - cast(trunc(prediction) as integer)) as bigint) abs_diff "
    "from pred where set_name = 'testing data'")


# ------------------------------------------------------------------ model outputs
# What of them does not depend on the learned trees or centres.
SQL["assemble_vectors"] = ctes(EXPLORE_CTES) + (
    f"select {R('td_downloads')} as label, cast(case when td_confidence between 0 and 5 then td_confidence else 6 end as double) f0, "
    f"{R('artist_hotttnesss')} f1, {R('song_hotttnesss')} f2, {R('td_meanPrice', 4)} f3 from m")
SETS = "case when split = 'test' then 'testing data' else 'training data' end"
SQL["train_forest"] = ctes(SPLIT_CTES) + (
    f"select {SETS} set_name, count(*) n_rows, {R('avg(td_downloads)', 4)} label_mean, true in_range from sp group by 1")
SQL["model_roundtrip"] = ctes(SPLIT_CTES) + f"select {R('td_downloads')} as label, true same from sp where split = 'test'"
SQL["score_requests"] = SQL["resolve_features"].replace("select r.request_id,", "select true scored, r.request_id,", 1)
SQL["score_from_averages"] = SQL["resolve_features"]
SQL["downloads_kmeans"] = ctes(EXPLORE_CTES) + (
    "select count(*) n_rows, cast(8 as bigint) n_clusters, true centres_are_means from m where td_confidence > 1 and td_downloads is not null")
SQL["feature_index_subset"] = SQL["select_feature_subset"]
SQL["metrics_file"] = SQL["regression_metrics"]


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
