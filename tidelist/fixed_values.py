"""The vocabularies, lookup tables, patterns and constants that results depend on.

Everything here is data, kept as plain text so that an analyst can read and edit it; no module
contains classification rules of its own. Patterns are written in RE2 syntax and translated once by
``functions.text.re2_pattern``.
"""

# ---- Fixed values: CSV rule tables (an empty cell is NULL) -----------------------------------

# Skills and the pattern that finds each of them in lower-cased text.
SKILL_VOCABULARY = r"""
skill,category,pattern
Python,language,\bpython\b
Java,language,\bjava\b
JavaScript,language,\bjavascript\b
TypeScript,language,\btypescript\b
Go,language,"\bgolang\b|(^|[,/(]\s*|\b(and|or|in|with|using)\s)go([,/);]|\.(\s|$)|$|\s+(and|or|with)\s)|\b(java|python|rust|ruby|scala|kotlin|javascript|typescript|c\+\+|c#|elixir),? (and|or) go\b"
Rust,language,\brust\b
C++,language,(^|[^a-z0-9])c\+\+
C#,language,(^|[^a-z0-9])c#
C,language,\bembedded c([^a-z0-9+#]|$)|(^|[^a-z0-9])c/c\+\+
SQL,language,\bsql\b
Bash,language,\bbash\b|\bshell scripting\b
React,framework,\breact\b
Node.js,framework,\bnode\.?js\b
Spring Boot,framework,\bspring boot\b
.NET,framework,(^|[^a-z0-9])\.net\b|\bdotnet\b
FastAPI,framework,\bfastapi\b
GraphQL,api,\bgraphql\b
REST API,api,\brest(ful)? apis?\b
AWS,cloud,\baws\b|\bamazon web services\b
Azure,cloud,\bazure\b
Google Cloud,cloud,\bgcp\b|\bgoogle cloud\b
Docker,devops,\bdocker\b
Kubernetes,devops,\bkubernetes\b|\bk8s\b
Terraform,devops,\bterraform\b
CI/CD,devops,\bci/cd\b|\bcontinuous integration\b
Linux,devops,\blinux\b
Prometheus,observability,\bprometheus\b
Grafana,observability,\bgrafana\b
Git,tool,\bgit\b
PostgreSQL,database,\bpostgres(ql)?\b
Kafka,data,\bkafka\b
Spark,data,\b(py)?spark\b
Airflow,data,\bairflow\b
dbt,data,\bdbt\b
Snowflake,data,\bsnowflake\b
BigQuery,data,\bbigquery\b
Data warehousing,data,\bdata warehous(e|es|ing)\b
pandas,data,\bpandas\b
NumPy,data,\bnumpy\b
Machine learning,ml,\bmachine learning\b|\bml\b
PyTorch,ml,\bpytorch\b
TensorFlow,ml,\btensorflow\b
scikit-learn,ml,\bscikit-learn\b|\bsklearn\b
Statistics,analytics,\bstatistic(s|al)\b
A/B testing,analytics,\ba/b test(s|ing)?\b
Tableau,analytics,\btableau\b
Power BI,analytics,\bpower bi\b
Excel,analytics,"\b(ms|microsoft|advanced|in|with|using) excel\b|\b(and|or) excel([.,;)]|$)|[,/(]\s*excel\b|\bexcel( (spreadsheets?|formulas?|pivot|vba|macros?|models?|modell?ing|dashboards?|skills|and|or)\b|[,/)])"
Selenium,testing,\bselenium\b
Playwright,testing,\bplaywright\b
pytest,testing,\bpytest\b
ROS,robotics,\bros ?2?\b
Unity,games,"\bunity ?3d\b|\bunity (engine|editor)\b|(\b(in|with|using|and|or)\s|[,/(]\s*)unity\b|\bunity([,/)]| (and|or) )"
Unreal Engine,games,\bunreal( engine)?\b
Figma,design,\bfigma\b
Accessibility,design,\bwcag\b|\ba11y\b|\b(web|digital|mobile|product) accessibility\b|\baccessibility (testing|standards|guidelines|best practices|audits?)\b
Salesforce,business,\bsalesforce\b
"""

# Role-family rules; the matching rule with the lowest priority wins.
ROLE_FAMILY_RULES = r"""
priority,role_family,pattern
10,data_science_ml,\b(machine learning|ml|ai|applied scientist|research scientist|data scientist)\b
20,data_engineering,\b(data engineer|analytics engineer|data platform)
30,security,\b(security|appsec)\b
40,data_analytics,\banalyst\b|\banalytics\b
50,devops_infra,\b(site reliability|sre|devops|platform engineer|infrastructure|cloud engineer)\b
60,qa_test,\b(qa|quality assurance|test|sdet)\b
70,embedded_hardware,\b(embedded|firmware|hardware|robotics|electrical)\b
80,product_management,\bproduct (manager|owner)\b
85,program_management,\b(program|project|delivery) manager\b|\btechnical program\b|\bscrum master\b
90,design,\b(designer|ux|ui)\b
100,software_engineering,\b(software|developer|engineer|engineering|programmer|backend|frontend|full[- ]stack|mobile|ios|android)\b
110,sales_business,"\b(account (executive|manager)|sales|marketing|operations|business development|customer|partner(ships)?|strategist|solutions|gtm|go-to-market|commercial|deal desk|pricing|consultant)\b"
120,corporate_functions,"\b(recruit(er|ing)|talent|people|hr|finance|accounting|accountant|counsel|legal|compliance|risk|administrative|executive assistant|payroll|tax|audit)\b"
"""

# Role families with their display names.
ROLE_FAMILIES = r"""
role_family,display_name,archetype
software_engineering,Software engineering,software
data_engineering,Data engineering,data
data_analytics,Data & business analytics,business
data_science_ml,Data science & ML,ml
devops_infra,DevOps & infrastructure,infra
qa_test,QA & test,qa
embedded_hardware,Embedded & hardware,embedded
security,Security,infra
product_management,Product management,business
design,Design,frontend
sales_business,Sales & business,business
program_management,Program & project management,business
corporate_functions,Corporate functions (people / finance / legal),business
other,Other,other
"""

# Location aliases: region codes, country names, cities. also_country marks a region code that is
# also the ISO code of that country.
GEO_ALIASES = r"""
alias,kind,region,country,also_country
on,region,Ontario,Canada,
qc,region,Quebec,Canada,
bc,region,British Columbia,Canada,
ab,region,Alberta,Canada,
mb,region,Manitoba,Canada,
sk,region,Saskatchewan,Canada,
ns,region,Nova Scotia,Canada,
nb,region,New Brunswick,Canada,
nl,region,Newfoundland and Labrador,Canada,
pe,region,Prince Edward Island,Canada,
yt,region,Yukon,Canada,
nt,region,Northwest Territories,Canada,
nu,region,Nunavut,Canada,
al,region,Alabama,United States,
ak,region,Alaska,United States,
az,region,Arizona,United States,
ar,region,Arkansas,United States,
ca,region,California,United States,Canada
co,region,Colorado,United States,
ct,region,Connecticut,United States,
de,region,Delaware,United States,
fl,region,Florida,United States,
ga,region,Georgia,United States,
hi,region,Hawaii,United States,
id,region,Idaho,United States,
il,region,Illinois,United States,
in,region,Indiana,United States,India
ia,region,Iowa,United States,
ks,region,Kansas,United States,
ky,region,Kentucky,United States,
la,region,Louisiana,United States,
me,region,Maine,United States,
md,region,Maryland,United States,
ma,region,Massachusetts,United States,
mi,region,Michigan,United States,
mn,region,Minnesota,United States,
ms,region,Mississippi,United States,
mo,region,Missouri,United States,
mt,region,Montana,United States,
ne,region,Nebraska,United States,
nv,region,Nevada,United States,
nh,region,New Hampshire,United States,
nj,region,New Jersey,United States,
nm,region,New Mexico,United States,
ny,region,New York,United States,
nc,region,North Carolina,United States,
nd,region,North Dakota,United States,
oh,region,Ohio,United States,
ok,region,Oklahoma,United States,
or,region,Oregon,United States,
pa,region,Pennsylvania,United States,
ri,region,Rhode Island,United States,
sc,region,South Carolina,United States,
sd,region,South Dakota,United States,
tn,region,Tennessee,United States,
tx,region,Texas,United States,
ut,region,Utah,United States,
vt,region,Vermont,United States,
va,region,Virginia,United States,
wa,region,Washington,United States,
wv,region,West Virginia,United States,
wi,region,Wisconsin,United States,
wy,region,Wyoming,United States,
dc,region,District of Columbia,United States,
canada,country,,Canada,
united states,country,,United States,
usa,country,,United States,
us,country,,United States,
u.s.,country,,United States,
united kingdom,country,,United Kingdom,
uk,country,,United Kingdom,
england,country,,United Kingdom,
ireland,country,,Ireland,
india,country,,India,
singapore,country,,Singapore,
japan,country,,Japan,
australia,country,,Australia,
mexico,country,,Mexico,
brazil,country,,Brazil,
south korea,country,,South Korea,
korea,country,,South Korea,
germany,country,,Germany,
france,country,,France,
netherlands,country,,Netherlands,
spain,country,,Spain,
poland,country,,Poland,
israel,country,,Israel,
switzerland,country,,Switzerland,
sweden,country,,Sweden,
new zealand,country,,New Zealand,
toronto,city,Ontario,Canada,
montreal,city,Quebec,Canada,
vancouver,city,British Columbia,Canada,
waterloo,city,Ontario,Canada,
ottawa,city,Ontario,Canada,
calgary,city,Alberta,Canada,
san francisco,city,California,United States,
sf,city,California,United States,
new york,city,New York,United States,
nyc,city,New York,United States,
seattle,city,Washington,United States,
chicago,city,Illinois,United States,
austin,city,Texas,United States,
boston,city,Massachusetts,United States,
denver,city,Colorado,United States,
los angeles,city,California,United States,
washington d.c.,city,District of Columbia,United States,
d.c.,city,District of Columbia,United States,
london,city,,United Kingdom,
dublin,city,,Ireland,
bengaluru,city,Karnataka,India,
bangalore,city,Karnataka,India,
mexico city,city,,Mexico,
tokyo,city,,Japan,
sydney,city,New South Wales,Australia,
seoul,city,,South Korea,
paris,city,,France,
berlin,city,,Germany,
amsterdam,city,,Netherlands,
sao paulo,city,,Brazil,
hyderabad,city,Telangana,India,
pune,city,Maharashtra,India,
mumbai,city,Maharashtra,India,
chennai,city,Tamil Nadu,India,
new delhi,city,Delhi,India,
delhi,city,Delhi,India,
gurugram,city,Haryana,India,
gurgaon,city,Haryana,India,
kitchener,city,Ontario,Canada,
mississauga,city,Ontario,Canada,
markham,city,Ontario,Canada,
edmonton,city,Alberta,Canada,
winnipeg,city,Manitoba,Canada,
halifax,city,Nova Scotia,Canada,
quebec city,city,Quebec,Canada,
"""

# ---- Fixed values: text rules ----------------------------------------------------------------

# HTML entities in the order they are decoded; &amp; is last so that one pass undoes one escaping.
HTML_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
]

# (pattern on the lower-cased provider label, employment type), first match wins.
EMPLOYMENT_LABEL_RULES = [
    (r"intern|co-?op", "internship"),
    (r"part", "part_time"),
    (r"contract|temporary|fixed", "contract"),
    (r"full", "full_time"),
]

INTERN_TITLE = r"\b(intern|internship|co-?op)\b"

# (pattern on the lower-cased title, pattern that vetoes the rule, seniority), first match wins.
SENIORITY_RULES = [
    (INTERN_TITLE, None, "intern"),
    (
        r"\b(staff|principal|distinguished|director|head of|vp|vice president|chief)\b",
        None,
        "staff_plus",
    ),
    (r"\b(senior|sr|lead)\b", None, "senior"),
    (r"\b(junior|jr|new grad|new graduate|graduate|entry[- ]level)\b", None, "entry"),
    (r"\bassociate\b", r"\bassociate (general )?counsel\b", "entry"),
]

# (text in the lower-cased location, workplace type), first match wins.
WORKPLACE_LOCATION_RULES = [("remote", "remote"), ("hybrid", "hybrid")]

# Lower-cased provider workplace label -> workplace type.
LEVER_WORKPLACE = {"remote": "remote", "hybrid": "hybrid", "on-site": "onsite"}
ASHBY_WORKPLACE = {"remote": "remote", "hybrid": "hybrid", "onsite": "onsite"}

LOCATION_SEPARATORS = r"[,;()/|-]"

# White space: a title of these characters alone is blank.
BLANKS = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# ---- Fixed values: domains and thresholds ----------------------------------------------------

SOURCES = ["greenhouse", "lever", "ashby"]
ALIAS_KINDS = ["country", "region", "city"]
STATUSES = ["ok", "failed", "contract_failed"]
FETCH_MODES = ["live", "fixture"]
WORKPLACE_TYPES = ["remote", "hybrid", "onsite", "unknown"]
EMPLOYMENT_TYPES = ["full_time", "part_time", "contract", "internship", "unknown"]
SENIORITIES = ["intern", "entry", "mid", "senior", "staff_plus"]
ENTRY_LEVELS = ["intern", "entry"]
ALL_ROLES = "all_roles"

MAX_REJECT_RATIO = 0.2
MAX_DROP_RATIO = 0.8
DROP_CHECK_MIN_POSTINGS = 10

# What the standard checks take for plausible, lowest and highest; callers may pass others.
CHECK_BOUNDS = {
    "unparsed_snapshots": (0, 1000),
    "spell_number": (1, 1000),
    "days_to_close": (1, 3650),
    "opened": (0, 1_000_000),
    "closed": (0, 1_000_000),
}
