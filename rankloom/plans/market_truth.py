"""Check SQL for the market queries, straight from the order tables.

It never reads the rendered texts: skills, years, degrees and certificates are
computed relationally, so parsing errors cannot cancel out; the words of the compared texts are
put together from the tables anew.
"""

from __future__ import annotations

FACTS = """
f AS (
  SELECT o_custkey AS c, l_suppkey AS s, o_orderstatus AS status, l_quantity AS q,
         l_returnflag AS flag, year(l_shipdate) AS shipped, p_type AS t, p_brand AS brand,
         CAST(substr(p_brand, 7) AS INT) AS b, p_type || ' ' || p_brand AS skill
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey),
cust AS (
  SELECT c_custkey AS c, c_name, c_acctbal, c_mktsegment AS seg, n_name, n_regionkey AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
supp AS (
  SELECT s_suppkey AS s, s_name, s_acctbal, n_name, n_regionkey AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
cs AS (SELECT DISTINCT c, t, b, skill FROM f WHERE q >= 25),
cp AS (SELECT DISTINCT c, status, t, b, skill FROM f WHERE q >= 45),
cb AS (SELECT c, b, brand, max(shipped) AS year FROM f WHERE flag = 'R' AND q >= 48 GROUP BY ALL),
jr AS (SELECT DISTINCT l_suppkey AS s, p_type AS t, CAST(substr(p_brand, 7) AS INT) AS b,
              p_type || ' ' || p_brand AS skill
       FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity >= 49),
jp AS (SELECT DISTINCT l_suppkey AS s, p_type AS t, CAST(substr(p_brand, 7) AS INT) AS b,
              p_type || ' ' || p_brand AS skill
       FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity = 48),
jb AS (SELECT DISTINCT l_suppkey AS s, CAST(substr(p_brand, 7) AS INT) AS b, p_brand AS brand
       FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE l_quantity = 50 AND l_returnflag = 'R'),
periods AS (
  SELECT o_custkey AS c, o_orderpriority AS priority, min(year(o_orderdate)) AS a,
         max(year(o_orderdate)) AS z
  FROM orders GROUP BY ALL),
cy AS (
  SELECT cust.c, CASE WHEN c_acctbal >= 0
           THEN coalesce((SELECT count(DISTINCT year(o_orderdate)) FROM orders WHERE o_custkey = cust.c), 0)
           ELSE coalesce((SELECT max(CASE WHEN z = 2001 THEN 2003 ELSE z END - a) FROM periods
                          WHERE periods.c = cust.c), 0) END::DOUBLE AS years
  FROM cust),
jy AS (SELECT s, greatest(floor(s_acctbal / 2000), 0)::DOUBLE AS years FROM supp),
pairs AS (SELECT DISTINCT o_custkey AS c, l_suppkey AS s
          FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""

_FEATURES = r"""
wanted AS (
  SELECT s, t, b, skill, bool_or(r) AS required
  FROM (SELECT *, true AS r FROM jr UNION ALL SELECT *, false FROM jp) GROUP BY s, t, b, skill),
wn AS (
  SELECT s, count(*) AS n,
         count(*) FILTER (t IN ('ECONOMY', 'LARGE')) AS n_lang,
         count(*) FILTER (t IN ('MEDIUM', 'PROMO')) AS n_fw,
         count(*) FILTER (t IN ('SMALL', 'STANDARD')) AS n_tool
  FROM wanted GROUP BY s),
hit AS (
  SELECT c, s, count(*) AS n, count(*) FILTER (required) AS n_req,
         count(*) FILTER (w.t IN ('ECONOMY', 'LARGE')) AS n_lang,
         count(*) FILTER (w.t IN ('MEDIUM', 'PROMO')) AS n_fw,
         count(*) FILTER (w.t IN ('SMALL', 'STANDARD')) AS n_tool
  FROM {pairs} p JOIN wanted w USING (s) JOIN cs USING (c, skill) GROUP BY c, s),
phit AS (
  SELECT c, s, count(*) AS n FROM {pairs} p JOIN wanted w USING (s)
  JOIN (SELECT DISTINCT c, skill FROM cp) USING (c, skill) GROUP BY c, s),
bhit AS (SELECT c, s, count(*) AS n FROM {pairs} p JOIN jb USING (s) JOIN cb USING (c, b) GROUP BY c, s),
bn AS (SELECT s, count(*) AS n FROM jb GROUP BY s),
total AS (SELECT c, count(*) AS n FROM cs GROUP BY c),
worked AS (
  SELECT c, status, string_agg(skill, ' ') AS names FROM cp GROUP BY c, status),
undertaken AS (
  SELECT st.c, string_agg(CASE WHEN seg = 'FURNITURE'
      THEN 'Ran the ' || st.status || ' pipeline with ' || coalesce(names, '') || ' for us.'
      ELSE 'Pipeline ' || st.status || ' ' || coalesce('worked on ' || names, '') END, ' ') AS projects
  FROM (SELECT DISTINCT o_custkey AS c, o_orderstatus AS status FROM orders) st
  JOIN cust USING (c) LEFT JOIN worked w ON w.c = st.c AND w.status = st.status GROUP BY st.c),
known AS (SELECT c, string_agg(skill, ' ') AS skills FROM cs GROUP BY c),
served AS (
  SELECT c, string_agg('Engineer on ' || priority || ' orders ' || a || ' - ' ||
    CASE WHEN z = 2001 THEN 'Present' ELSE z::VARCHAR END, ' ') AS experience FROM periods GROUP BY c),
proved AS (
  SELECT cb.c, string_agg('Certified ' || brand || ' handler - Board ' || region || ', ' || year, ' ') AS certificates
  FROM cb JOIN cust USING (c) GROUP BY cb.c),
active AS (
  SELECT o_custkey AS c, count(DISTINCT year(o_orderdate)) AS n, min(year(o_orderdate)) AS first_year
  FROM orders GROUP BY o_custkey),
ctext AS (
  SELECT c, concat_ws(' ', CASE WHEN seg = 'HOUSEHOLD' THEN seg ELSE seg || ' ' || n_name END,
    'customer' || c || '@example.com', (c_nationkey + 10), '555', lpad(c::VARCHAR, 7, '0'),
    CASE WHEN cust.c_acctbal >= 0 THEN 'Profile: ' || coalesce(n, 0) || ' years of experience in supply'
         ELSE 'Profile: open to new work in supply' END,
    'Open for talks about all kinds of supply work Based in', n_name, 'with the sales desk of the region',
    'Technical Skills:', skills, 'Work Experience', experience, 'Education', {degree}, n_name, 'College', first_year,
    'Certifications', certificates, 'Projects', projects) AS text
  FROM cust JOIN customer ON c_custkey = c LEFT JOIN undertaken USING (c) LEFT JOIN known USING (c)
  LEFT JOIN served USING (c) LEFT JOIN proved USING (c) LEFT JOIN active USING (c)),
needs AS (SELECT s, string_agg(skill, ' ') AS required FROM jr GROUP BY s),
likes AS (SELECT s, string_agg(skill, ' ') AS preferred FROM jp GROUP BY s),
wants AS (SELECT s, string_agg(skill, ' ') AS listed FROM (SELECT DISTINCT s, skill FROM (FROM jr UNION ALL FROM jp))
  GROUP BY s),
asks AS (SELECT s, string_agg('Certified ' || brand || ' handler', ' ') AS brands FROM jb GROUP BY s),
jtext AS (
  SELECT s, concat_ws(' ', s_name, required, preferred, {region_degree}, jy.years, brands, listed,
    'Serve the ' || n_name || ' market Ship on time', jy.years::INT || '+ years of supply work',
    s_name, 'Required Skills', required, 'Nice to have', preferred,
    CASE WHEN region < 4 THEN 'Education ' || {region_degree} END, 'Certifications', brands,
    'Responsibilities Serve the ' || n_name || ' market Ship on time', 'Minimum Qualifications',
    jy.years::INT || '+ years of supply work') AS text
  FROM supp JOIN jy USING (s) LEFT JOIN needs USING (s) LEFT JOIN likes USING (s) LEFT JOIN wants USING (s)
  LEFT JOIN asks USING (s)),
ct AS (SELECT c, term, count(*) AS tf FROM
        (SELECT c, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM ctext) GROUP BY c, term),
jt AS (SELECT s, term, count(*) AS tf FROM
        (SELECT s, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM jtext) GROUP BY s, term),
cn AS (SELECT c, sum(tf * tf) AS n FROM ct GROUP BY c),
jn AS (SELECT s, sum(tf * tf) AS n FROM jt GROUP BY s),
dots AS (SELECT c, s, sum(ct.tf * jt.tf) AS dot FROM {pairs} p JOIN jt USING (s) JOIN ct USING (c, term)
         GROUP BY c, s),
feat AS (
  SELECT p.c, p.s,
    CASE WHEN cn.n > 0 AND jn.n > 0
      THEN greatest(least(coalesce(dots.dot, 0) / (sqrt(cn.n) * sqrt(jn.n)), 1.0), 0.0)
      ELSE 0.0 END::DOUBLE AS semantic_similarity,
    coalesce(coalesce(hit.n, 0)::DOUBLE / wn.n, 0.0::DOUBLE) AS skill_match_percentage,
    CASE WHEN jy.years <= 0 THEN 0.0 ELSE least(cy.years / jy.years, 1.0) END::DOUBLE
      AS experience_match_score,
    CASE WHEN (region = 0 AND seg = 'AUTOMOBILE')
           OR (region = 1 AND seg IN ('BUILDING', 'FURNITURE', 'MACHINERY'))
           OR (region IN (2, 3) AND seg IN ('FURNITURE', 'MACHINERY'))
         THEN 1.0 ELSE 0.0 END::DOUBLE AS education_match_score,
    coalesce(coalesce(bhit.n, 0)::DOUBLE / bn.n, 0.0::DOUBLE) AS certification_match_score,
    coalesce(coalesce(phit.n, 0)::DOUBLE / wn.n, 0.0::DOUBLE) AS project_relevance_score,
    CASE WHEN wn.n_lang > 0 THEN coalesce(hit.n_lang, 0)::DOUBLE / wn.n_lang ELSE 0.0 END
      AS programming_language_match,
    CASE WHEN wn.n_fw > 0 THEN coalesce(hit.n_fw, 0)::DOUBLE / wn.n_fw ELSE 0.0 END
      AS framework_match,
    CASE WHEN wn.n_tool > 0 THEN coalesce(hit.n_tool, 0)::DOUBLE / wn.n_tool ELSE 0.0 END
      AS tools_match,
    abs(cy.years - jy.years) AS years_of_experience_difference,
    coalesce(hit.n_req, 0)::DOUBLE AS number_of_matching_skills,
    coalesce(total.n, 0)::DOUBLE AS total_candidate_skills,
    region < 4 AS has_education, coalesce(bn.n, 0) > 0 AS has_certification,
    coalesce(wn.n_lang, 0) > 0 AS has_language, coalesce(wn.n_fw, 0) > 0 AS has_framework,
    coalesce(wn.n_tool, 0) > 0 AS has_tool
  FROM {pairs} p
  JOIN (SELECT c, seg FROM cust) USING (c) JOIN (SELECT s, region FROM supp) USING (s)
  JOIN cy USING (c) JOIN jy USING (s)
  LEFT JOIN hit USING (c, s) LEFT JOIN phit USING (c, s) LEFT JOIN bhit USING (c, s)
  LEFT JOIN dots USING (c, s) LEFT JOIN wn USING (s) LEFT JOIN bn USING (s)
  LEFT JOIN total USING (c) LEFT JOIN cn USING (c) LEFT JOIN jn USING (s)),
scored AS (
  SELECT *, least(greatest(0.40::DOUBLE * semantic_similarity + 0.20::DOUBLE * skill_match_percentage
    + 0.15::DOUBLE * experience_match_score + 0.10::DOUBLE * education_match_score
    + 0.05::DOUBLE * certification_match_score + 0.05::DOUBLE * programming_language_match
    + 0.03::DOUBLE * framework_match + 0.02::DOUBLE * tools_match, 0.0), 1.0) * 100.0 AS score
  FROM feat),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY round(score, 6) DESC, c::VARCHAR) AS rank
  FROM scored)"""


def features(pairs: str = "pairs") -> str:
    """FACTS plus feat, scored and ranked over a pair relation."""
    filled = _FEATURES.replace("{pairs}", pairs).replace("{degree}", DEGREE).replace("{region_degree}", REGION_DEGREE)
    return "WITH " + FACTS + "," + filled


#: What rankings and reports show; a candidate without a name is shown by its id.
SHOWN = "CASE WHEN seg = 'HOUSEHOLD' THEN c::VARCHAR ELSE seg || ' NATION' END"
NAME = "CASE WHEN seg = 'HOUSEHOLD' THEN '' ELSE seg || ' NATION' END"
DEGREE = (
    "CASE seg WHEN 'AUTOMOBILE' THEN 'Ph.D' WHEN 'BUILDING' THEN 'Master''s' "
    "WHEN 'FURNITURE' THEN 'B.Sc' WHEN 'HOUSEHOLD' THEN 'MBA' ELSE 'B.Tech' END || ' in ' || seg"
)
REGION_DEGREE = (
    "CASE region WHEN 0 THEN 'Doctorate required' WHEN 1 THEN 'Master''s degree in any field' "
    "WHEN 2 THEN 'Bachelor level or above' WHEN 3 THEN 'degree in any field' ELSE '' END"
)
PROJECTS = """
projects AS (
  SELECT st.c, string_agg(
    CASE WHEN seg = 'FURNITURE'
      THEN 'Ran the ' || st.status || ' pipeline with ' || coalesce(names, '') || ' for us.::'
      ELSE 'Pipeline ' || st.status || ':' || coalesce('worked on ' || names, '') || ':'
    END || coalesce(names, ''), '|' ORDER BY st.status) AS projects
  FROM (SELECT DISTINCT o_custkey AS c, o_orderstatus AS status FROM orders) st
  JOIN cust USING (c)
  LEFT JOIN (SELECT c, status, string_agg(skill, ', ' ORDER BY t, b) AS names FROM cp
             GROUP BY c, status) n ON n.c = st.c AND n.status = st.status
  GROUP BY st.c)"""
