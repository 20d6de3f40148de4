"""Secret scans: candidates by pattern, false positives removed by a random forest.

Candidates are long runs of the characters that keys consist of, whole private keys, and
whatever is assigned to a name like password or token or stands as user:password@, however
short. Each is described by its length, the transitions between kinds of characters, how
much of it words cover, whether it stands in a path, and the words next to it. A random
forest trained from labelled findings
decides which are secrets. It is written out as one SQL expression, so that texts are
scanned, judged and redacted row by row in the JVM, without any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A private key from its head to its end; without an end, the head and the lines of key characters after it.
PRIVATE_KEY = (
    r"-----BEGIN [A-Z0-9 ]{0,20}PRIVATE KEY(?: BLOCK)?-----"
    r"(?:[^-]*+(?:-(?!----)[^-]*+){0,400}+-----END [A-Z0-9 ]{0,20}PRIVATE KEY(?: BLOCK)?-----"
    r"|(?:(?:\s|\\[nr]){1,4}+[A-Za-z0-9+/=]{16,}+){1,400}+(?:(?:\s|\\[nr]){1,4}+[A-Za-z0-9+/]++={0,2}+\z)?+"
    r"|)"
)
#: What stands between a user and a host, up to the last @ before the host: after ``//user:``, or after ``user:`` with
#: at most three further colons. Runs that begin at different colons hardly overlap, so that the search is linear.
USERINFO = (
    r"""(?<=:)(?:(?<=//[^\s/:@"'<>]{0,256}:)[^\s/"'<>]+(?=@[\w\[])"""
    r"""|(?<=[\w.%+-]:)[^\s/"'<>:]+(?::[^\s/"'<>:]*){0,3}(?=@[\w\[]))"""
)
#: The end of a name that secrets are assigned to, the sign, and an opening quote.
NAMED = (
    r"(?:pass|pwd|secret|token|credential|authorization|(?<![a-z])auth(?![a-z])|bearer"
    r"|(?:api|access|private|encryption|signing|master|account|service|session|shared|client|storage|ssh|aws)[_. -]?key)"
    r"[\w.\]-]{0,24}(?:\\?[\"'`])?[\"'`\]]?(?:[ \t]?:[ \t]?[a-z]{1,12})?[ \t]{0,3}(?:[!=]?={1,2}>?|:=?|[?]=)[ \t]{0,3}"
    r"(?:(?:bearer|basic|token|digest)[ \t])?"
)
#: A value: between quotes, or up to white space, without closing punctuation and further fields. Without quotes it
#: holds at most 40 runs of = and :, so that a chain of names and signs is not searched to its end from each of them;
#: a quote with a backslash before it opens no value but that up to the next of its kind.
ASSIGNED = (
    # The first tests are cheap and fail nearly everywhere, so that names are seldom looked for.
    r"""(?<=[=:>"'`\\ \t])(?<=[=:>]["'`\\ \t]{0,5}|(?i:earer|asic|oken|igest)[ \t]["'`\\]{0,2})"""
    rf"""(?<=(?i:{NAMED})(?:\\?["'`])?)(?:"""
    r"""(?<=\\")[^"\\\r\n]++(?=\\")"""
    r"""|(?<=")(?<!\\")(?:[^"\\\r\n]++|\\.)++(?=")"""
    r"""|(?<=')(?<!\\')(?:[^'\\\r\n]++|\\.)++(?=')"""
    r"""|(?<=`)[^`\r\n]++(?=`)"""
    r"""|(?!(?i:bearer|basic|token|digest)[ \t])(?!\\["'])(?=[^\s=:"'`>])[^\s=:]+?(?:[=:]++[^\s=:]*?){0,40}?"""
    r"""(?=[.,;:!?)\]}>"'`\\]{0,3}(?:\s|\z)|[&;,][\w.-]{1,40}[=:]|["']\s?/?>|</))"""
)
#: A run of key characters with a digit or a change to upper case in it, from after any = on.
RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9+/_-]{16,}+(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
CANDIDATE = f"{PRIVATE_KEY}|{USERINFO}|{ASSIGNED}|{RUN}"
#: Every name that ``ASSIGNED`` looks for holds one of these.
STEMS = ("pass", "pwd", "secret", "token", "credential", "auth", "bearer", "key")
BEFORE, AFTER = 48, 24
REDACTED = "[SECRET]"

#: Words that cover parts of names and paths, but not of keys.
WORDS = (
    "account action address admin array asset author backup batch block board buffer build button cache center "
    "chain change channel chart check class clear client clock cloud cluster code color column command config "
    "connect content control count create data date default delete design detail device display document download "
    "driver email entry error event factory field figure file filter final folder format frame function global "
    "graph group handler header history home image import index info input install item label layout length level "
    "library limit line link list load local location main manager market master media member memory menu message "
    "method model module month mouse name network node note number object offset open option order output owner "
    "package page panel parent path pattern phone picture plan point policy price print process product profile "
    "project public query random range read record region release remote report request reset result return route "
    "scale schema screen script search section select sender server service session setting shape share size sort "
    "source space start state status step store stream string style submit summary switch system table target "
    "task theme time title track type update upload user value vector version video view visit week white width "
    "window word work world year"
).split()

#: Expressions of a candidate ``c`` with ``c.text``, ``c.before``, ``c.after`` and ``c.kinds`` (each character as 0, a, A or -).
FEATURES = {
    "length": "length(c.text)",
    "digits": "(length(c.kinds) - length(replace(c.kinds, '0', ''))) / length(c.text)",
    "uppers": "(length(c.kinds) - length(replace(c.kinds, 'A', ''))) / length(c.text)",
    "symbols": "(length(c.kinds) - length(replace(c.kinds, '-', ''))) / length(c.text)",
    "transitions": "length(regexp_replace(c.kinds, '(.)\\\\1+', '$1')) / length(c.text)",
    "letters_run": "coalesce(array_max(transform(regexp_extract_all(c.kinds, '[aA]+', 0), r -> length(r))), 0) / length(c.text)",
    "distinct": "size(array_distinct(split(c.text, ''))) / least(length(c.text), 64)",
    "repeated": "coalesce(array_max(transform(regexp_extract_all(c.text, '(.)\\\\1+', 0), r -> length(r))), 1)",
    "hexadecimal": "cast(c.text rlike '^([0-9a-f]+|[0-9A-F]+)$' as double)",
    "grouped": "cast(c.text rlike '^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$' as double)",
    "vowels": "length(regexp_replace(lower(c.text), '[^aeiou]', '')) / greatest(1, length(regexp_replace(c.text, '[^A-Za-z]', '')))",
    "words": f"1 - length(regexp_replace(lower(c.text), '({'|'.join(WORDS)})', '')) / length(c.text)",
    "slashes": "(length(c.text) - length(replace(c.text, '/', '')))",
    "in_path": "cast(c.before rlike '(://[^ ]*|[/.@#])$' or c.after rlike '^[.][a-z]{2,4}([^a-z]|$)' as double)",
    "head": "cast(c.text rlike '^(AKIA|ASIA|gh[pousr]_|xox[abp]-|sk[-_]|eyJ|AIza|-----BEGIN)' as double)",
    "key_word": "cast(lower(c.before) rlike '(token|secret|passw|pwd|api.?key|access.?key|private|credential|bearer|auth)[^a-z]*$' as double)",
    "key_near": "cast(lower(c.before) rlike '(token|secret|passw|pwd|key|credential|bearer|auth)' as double)",
    "assigned": "cast(c.before rlike '[=:] ?[\"'']?$' as double)",
    "quoted": "cast(c.before rlike '[\"'']$' and c.after rlike '^[\"'']' as double)",
    "harmless_word": "cast(lower(c.before) rlike '(commit|sha.?[0-9]*|md5|checksum|digest|hash|revision|etag|uuid|guid|build|isbn|order|invoice|card|phone|serial|example|sample|dummy|test|fake)[^a-z]*$' as double)",
    "userinfo": "cast(c.before rlike '//[^ /]*:$' and c.after rlike '^@' as double)",
    "before_at": "cast(c.before rlike ':$' and c.after rlike '^@' as double)",
    "reference": "cast(c.text rlike '^[$%<{*(]|[({]|^(os|self|this|config|settings|env|process|request|args|params|data|https?:/)[.:/]' as double)",
    "dull": "cast(lower(c.text) rlike '^(true|false|null|none|nil|undefined|string|str|int|required|optional|changed|expired|invalid|missing|unknown|yes|no|the|a|an|is|to|and|not|if|for|all|any|please|see|from|this|that|your|it|[0-9]{1,3})$' as double)",
    "spaces": "length(c.text) - length(replace(c.text, ' ', ''))",
    "placeholder": "cast(lower(c.text) rlike '(example|sample|dummy|placeholder|your|changeme|test|fake|xxxx|0000|1234567|abcdef0|abcdefg)' as double)",
}
NAMES = list(FEATURES)

TREES = 24
DEPTH = 6
SPLITS = 16
#: Labelled findings that a forest is trained on, at most.
TRAIN_ROWS = 6000


@dataclass
class Node:
    """An inner node with both sides, or a leaf with its share of secrets."""

    share: float
    feature: int = -1
    border: float = 0.0
    low: Node | None = None
    high: Node | None = None

    def sql(self, row: str) -> str:
        if self.low is None or self.high is None:
            return f"{self.share:.6f}D"
        test = f"{row}.{NAMES[self.feature]} <= {self.border!r}D"
        return f"(CASE WHEN {test} THEN {self.low.sql(row)} ELSE {self.high.sql(row)} END)"

    def shares(self, x: np.ndarray) -> np.ndarray:
        if self.low is None or self.high is None:
            return np.full(len(x), self.share)
        return np.where(x[:, self.feature] <= self.border, self.low.shares(x), self.high.shares(x))


def _tree(x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.Generator) -> Node:
    share = float(y.mean())
    if depth == 0 or len(y) < 8 or share in (0.0, 1.0):
        return Node(share)
    best = (1e-12, -1, 0.0)
    whole = len(y) * share * (1 - share)
    for f in rng.choice(x.shape[1], max(1, round(np.sqrt(x.shape[1]) + 1)), replace=False).tolist():
        values = x[:, f]
        borders = np.unique(np.quantile(values, np.linspace(0, 1, SPLITS + 1)[1:-1], method="lower"))
        for border in borders[borders < values.max()].tolist():
            low = values <= border
            a, b = y[low], y[~low]
            gain = whole - len(a) * a.mean() * (1 - a.mean()) - len(b) * b.mean() * (1 - b.mean())
            if gain > best[0]:
                best = (gain, f, border)
    if best[1] < 0:
        return Node(share)
    low = x[:, best[1]] <= best[2]
    return Node(share, best[1], best[2], _tree(x[low], y[low], depth - 1, rng), _tree(x[~low], y[~low], depth - 1, rng))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 5) -> list[Node]:
    """A forest: every tree on a bootstrap sample, every split among some of the features."""
    rng = np.random.default_rng(seed)
    if not len(y):
        return [Node(0.0)]
    forest = []
    for _ in range(trees):
        rows = rng.integers(0, len(y), len(y))
        forest.append(_tree(x[rows], y[rows], depth, rng))
    return forest


def forest_sql(forest: list[Node], row: str) -> str:
    return f"({' + '.join(tree.sql(row) for tree in forest)}) / {len(forest)}"


def _sql_text(text: str) -> str:
    """A string as an SQL literal, backslashes as they stand."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


KINDS = "translate(regexp_replace(regexp_replace(regexp_replace(t, '[^A-Za-z0-9]', '-'), '[a-z]', 'a'), '[A-Z]', 'A'), '123456789', '000000000')"


def _described(parts: str) -> str:
    """From structs with text, before and after: structs with the features as well."""
    kinds = KINDS.replace("(t,", "(d.text,", 1)
    with_kinds = f"transform({parts}, d -> struct(d.text AS text, d.before AS before, d.after AS after, {kinds} AS kinds))"
    listed = ", ".join(f"cast({sql} as double) AS {name}" for name, sql in FEATURES.items())
    return f"transform({with_kinds}, c -> struct(c.text AS text, c.before AS before, c.after AS after, {listed}))"


def describe(findings: DataFrame) -> DataFrame:
    """The columns of ``findings`` (text, before, after ...) with one column for each feature."""
    one = "array(struct(text, coalesce(before, '') AS before, coalesce(after, '') AS after))"
    rows = findings.where("text is not null and text <> ''").withColumn("_c", F.expr(_described(one))[0])
    return rows.select(*findings.columns, *(F.col(f"_c.{n}").alias(n) for n in NAMES))


def fit(findings: DataFrame, rows: int = TRAIN_ROWS) -> list[Node]:
    """Train on at most ``rows`` labelled findings (text, before, after, secret), drawn by hash.

    Findings without label or text are left out. Without any, nothing is a secret.
    """
    drawn = findings.where("secret is not null and text is not null").orderBy(F.xxhash64("text", "before", "after"), "text").limit(rows)
    found = describe(drawn).select(*NAMES, F.col("secret").cast("double").alias("secret")).collect()
    table = np.array([tuple(r) for r in found], float).reshape(-1, len(NAMES) + 1)
    table = table[np.lexsort(table.T)]
    return grow(table[:, :-1], table[:, -1])


def labelled_findings(spark: SparkSession, rows: int = TRAIN_ROWS) -> DataFrame:
    """Findings with labels, made from hashes of row numbers: keys where keys stand, and what only looks like them."""
    word = "element_at(array({}), cast(pmod(xxhash64(id, {}), {}) as int) + 1)"
    listed = ", ".join(f"'{w}'" for w in WORDS)

    def pick(salt: int, *options: str) -> str:
        return word.format(", ".join(_sql_text(o) for o in options), salt, len(options))

    def name(salt: int) -> str:
        return word.format(listed, salt, len(WORDS))

    # Each salt gives digests of its own; base64 of raw digests mixes all kinds of characters.
    hexa, longer = "sha1(concat('h', id))", "sha2(concat('l', id), 256)"
    raw = "regexp_replace(base64(unhex(sha2(concat('b', id), 256))), '[+/=]', '')"
    keyed = pick(1, 'token = "', "token: ", 'api_key = "', "secret=", "password: '", "Authorization: Bearer ", 'access_key="', "auth_token = ", "my secret key is ", "export API_KEY=")
    prose = pick(2, "see the notes on ", "of the ", "and then ", "was named ", "in ", "", "it is called ", "= ", ": ")
    passed = pick(68, 'password = "', 'password: "', "password=", "PASSWORD=", "passwd: ", "pwd=", "DB_PASS='", '"password": "', "secret: ", "token=", "client_secret = '", "api_key: ")
    counted = pick(3, "commit ", "sha256: ", "sha1=", "md5 ", "checksum: ", "digest ", "revision ", "etag: ", 'hash = "', "build ", "uuid ", "order ", "card ", "serial ")
    closing = pick(4, '"', "'", " ", "\n", "", " and the ")
    shapes = [
        (hexa, keyed, closing, 1),
        (f"substr({longer}, 1, cast(32 + pmod(id, 3) * 16 as int))", keyed, closing, 1),
        (f"substr({raw}, 1, cast(20 + pmod(id, 20) as int))", keyed, closing, 1),
        (f"concat('AKIA', substr(upper(translate({raw}, 'abcdef', 'GHJKLM')), 1, 16))", f"coalesce({pick(5, 'aws ', '', 'id = ', 'key: ')}, '')", closing, 1),
        (f"concat({pick(6, 'ghp_', 'sk_', 'gho_', 'sk-')}, substr({raw}, 1, 36))", prose, closing, 1),
        (f"concat('eyJ', {raw}, 'eyJ', {raw})", keyed, closing, 1),
        (f"substr({raw}, 1, 32)", f"concat({pick(7, 'key', 'secret', 'credential')}, {pick(8, ' ', ' = ', ': ')})", closing, 1),
        (hexa, counted, closing, 0),
        (f"substr({longer}, 1, cast(32 + pmod(id, 3) * 16 as int))", counted, closing, 0),
        (f"substr({hexa}, 1, 32)", prose, closing, 0),
        ("concat_ws('-', substr(md5(cast(id as string)), 1, 8), substr(md5(cast(id as string)), 9, 4), substr(md5(cast(id as string)), 13, 4), substr(md5(cast(id as string)), 17, 4), substr(md5(cast(id as string)), 21, 12))", f"concat({prose}, {pick(9, '', 'uuid ', 'id ')})", closing, 0),
        (f"concat({name(10)}, initcap({name(11)}), initcap({name(12)}), pmod(id, 97))", prose, closing, 0),
        (f"concat_ws('_', {name(13)}, {name(14)}, {name(15)}, pmod(id, 2030))", f"concat({keyed})", closing, 0),
        (f"concat_ws('/', {name(16)}, {name(17)}, {name(18)}, pmod(id, 2030))", pick(19, "http://", "https://www.", "/usr/", "./", "path: "), pick(20, ".html", ".png", ".py", " "), 0),
        ("lpad(cast(abs(xxhash64(id)) as string), 16, '4')", f"concat({prose}, {pick(21, '', 'card ', 'phone ')})", closing, 0),
        (f"concat({pick(22, 'YOUR_', 'EXAMPLE_', 'SAMPLE_', 'test_', 'dummy_')}, {pick(23, 'TOKEN', 'API_KEY', 'SECRET', 'PASSWORD')}, '_', repeat({pick(24, 'x', '0', '1234', 'abc')}, 6), '1')", keyed, closing, 0),
        (f"concat(repeat({pick(25, 'x', '0', 'a1', '=', '-', 'ab')}, 20), pmod(id, 10))", keyed, closing, 0),
        (f"concat({pick(28, 'hunter', 'dragon', 'monkey', 'summer', 'letmein', 'qwerty', 'Winter', 'Passw0rd')}, pmod(id, 2030))", passed, closing, 1),
        (f"concat({pick(29, 'c0rrect', 'Tr0ub', 'h0rse', 'Sup3r', 'p4ss', 'b4ttery')}, {pick(30, '!', '#', '$', '@', '&', '^', '*', '%')}, initcap({name(31)}), {pick(32, '#', '!', '9', '?', '+')}, pmod(id, 97))", passed, closing, 1),
        (f"substr({raw}, 1, cast(6 + pmod(id, 14) as int))", passed, closing, 1),
        (f"concat(substr({raw}, 1, 8), {pick(33, '!', '#', ' ', '.', '~', ':')}, substr({raw}, 9, cast(4 + pmod(id, 9) as int)))", pick(34, 'password = "', 'passwd: "', '"password": "', 'SECRET="', 'db_pass = "', 'passphrase: "'), pick(35, '"', '",', '" '), 1),
        (f"concat(substr({raw}, 1, cast(6 + pmod(id, 16) as int)), {pick(36, '', '!', '$', '9')})", f"concat({pick(37, 'postgres://bob:', 'mysql://root:', 'https://user:', 'redis://:', 'amqp://guest:', 'ftp://admin:', 'mongodb://app:')})", pick(38, "@db/x", "@localhost:5432/app", "@example.com/", "@10.0.0.1"), 1),
        (f"concat({pick(39, 'hunter', 'dragon', 'S3cret', 'secret', 'letmein')}, pmod(id, 2030))", pick(40, "postgres://bob:", "mysql://root:", "https://user:", "redis://:", "bob:", "admin:"), pick(41, "@db/x", "@localhost:5432/app", "@example.com/"), 1),
        (f"concat('-----BEGIN ', {pick(42, 'RSA ', 'EC ', '', 'OPENSSH ')}, 'PRIVATE KEY-----\\n', repeat(concat({raw}, '\\n'), cast(1 + pmod(id, 3) as int)), '-----END PRIVATE KEY-----')", pick(43, "", "key:\n", "see "), pick(44, "\n", "", " "), 1),
        (f"concat('-----BEGIN ', {pick(74, 'RSA ', 'EC ', '', 'OPENSSH ')}, 'PRIVATE KEY-----\\n', repeat(concat({raw}, '\\n'), cast(1 + pmod(id, 40) as int)), '-----END PRIVATE KEY-----')", pick(75, "", "key:\n", "see "), pick(76, "\n", "", " "), 1),
        (f"concat('-----BEGIN ', {pick(77, 'RSA ', 'EC ', '', 'OPENSSH ')}, 'PRIVATE KEY-----\\\\n', repeat(concat({raw}, '\\\\n'), cast(1 + pmod(id, 20) as int)), '-----END PRIVATE KEY-----')", pick(78, "", "key:\n", "see "), pick(79, "\n", "", " "), 1),
        (f"{pick(45, '-----BEGIN RSA PRIVATE KEY-----', '-----BEGIN PRIVATE KEY-----')}", pick(46, "a file with ", "the line ", "starts with "), pick(47, " is a key", " and more", "."), 0),
        (pick(48, "required", "string", "true", "null", "None", "expired", "optional", "invalid", "the", "a", "not", "12", "see", "please", "changed"), passed, closing, 0),
        (name(49), passed, closing, 0),
        (f"concat({pick(50, '${', 'get_', 'os.environ[', 'self.', 'config.', '<your-', 'process.env.')}, upper({name(51)}), {pick(52, '}', '()', ']', '_KEY', '>')})", passed, pick(53, " ", "\n", ";"), 0),
        (f"concat({name(54)}, ' ', {name(55)}, ' ', {name(56)})", pick(57, 'password: "', 'token = "', 'secret: "'), pick(58, '"', '",'), 0),
        (name(59), pick(60, "mailto:", "email:", "contact:", "from:", "cc:"), pick(61, "@example.com", "@mail.org"), 0),
        (f"concat({name(62)}, '.', {name(63)})", pick(64, "mailto:", "email:", "contact:", "https://example.com:"), pick(65, "@example.com", "@mail.org"), 0),
        (f"initcap({name(71)})", pick(72, "secretary: ", "passenger: ", "Passage: ", "tokenizer: ", "tokens: ", "secret: ", "compass: "), pick(73, " ", ", ", "."), 0),
        (f"concat('https://example.com/', {name(66)})", pick(67, "auth: ", "token_url = ", "auth_url: ", "secret: "), closing, 0),
        (f"substr({raw}, 1, 40)", pick(26, "data:image/png;base64,", "src=/static/", "integrity sha384-", "https://cdn.example.com/", "?v="), pick(27, ".js", ".png", ".css", "=="), 0),
    ]
    ids = spark.range(rows)
    # By hash, so that a split of the rows by number leaves no shape out.
    case = "CASE pmod(xxhash64(id, 80), {}) {} END"

    def choose(at: int) -> str:
        return case.format(len(shapes), " ".join(f"WHEN {i} THEN {s[at]}" for i, s in enumerate(shapes)))

    planted = ids.selectExpr(f"{choose(0)} AS planted", f"{choose(1)} AS lead", f"{choose(2)} AS tail", f"{choose(3)} AS label", "id")
    # The texts are searched as any other, so that findings look as they do in scans.
    around = word.format("'', 'a line of words\\n', 'set '", 69, 3), word.format("'', '\\n', ' and so on'", 70, 3)
    made = planted.withColumn("text", F.expr(f"concat({around[0]}, lead, planted, tail, {around[1]})"))
    # The outer form, as a filter of empty lists would repeat the whole search below it.
    listed = with_candidates(made).withColumn("_one", F.explode_outer("_listed"))
    one = listed.selectExpr("_one.text AS text", "_one.before AS before", "_one.after AS after", "label", "planted", "id")
    hit = "contains(planted, text) or contains(text, planted)"
    return one.selectExpr("text", "before", "after", f"if({hit}, label, 0) AS secret", "id")


def with_candidates(texts: DataFrame) -> DataFrame:
    """``texts`` with the candidates of ``text`` (``_runs``), what stands between them (``_rest``) and both together (``_listed``).

    What stands before and after a candidate may reach into its neighbours.
    """
    # Where a text has no @ or none of the names, the parts of the pattern that need them cannot match and are left
    # out: they look back from many places, which is most of the work.
    low = texts.withColumn("_low", F.lower("text"))
    named = " OR ".join(f"contains(_low, '{stem}')" for stem in STEMS)
    marked = low.withColumn("_named", F.expr(named)).withColumn("_at", F.expr("contains(text, '@')")).drop("_low")

    def by_pattern(call: str) -> str:
        """``call`` with the pattern of every combination of both marks."""
        cases = []
        for has_at, has_name in ((False, False), (False, True), (True, False), (True, True)):
            parts = [PRIVATE_KEY, *[USERINFO] * has_at, *[ASSIGNED] * has_name, RUN]
            cases.append(f"WHEN {'' if has_at else 'NOT '}_at AND {'' if has_name else 'NOT '}_named THEN {call.format(_sql_text('|'.join(parts)))}")
        return f"CASE {' '.join(cases)} END"

    runs = marked.withColumn("_runs", F.expr(by_pattern("regexp_extract_all(text, {}, 0)")))
    # One part more than there are candidates.
    split = by_pattern("split(text, {}, -1)")
    parts = runs.withColumn("_rest", F.expr(f"CASE WHEN size(_runs) > 0 THEN {split} END")).drop("_named", "_at")
    before = f"right(concat(coalesce(right(get(_runs, i - 1), {BEFORE}), ''), right(_rest[i], {BEFORE})), {BEFORE})"
    after = f"left(concat(left(_rest[i + 1], {AFTER}), coalesce(left(get(_runs, i + 1), {AFTER}), '')), {AFTER})"
    listed = f"transform(_runs, (r, i) -> struct(r AS text, {before} AS before, {after} AS after))"
    return parts.withColumn("_listed", F.expr(listed))


def scan(docs: DataFrame, forest: list[Node], threshold: float = 0.5) -> DataFrame:
    """The columns of ``docs`` with ``findings`` and ``redacted``.

    ``findings`` lists the candidates of ``text`` in order, each with ``text``,
    ``score`` and ``secret``; in ``redacted`` every secret is replaced. Null texts
    have no findings and stay null, as do texts without candidates. Columns of the
    same names are replaced, others stay; rows are judged alone.
    """
    given = docs.drop("findings", "redacted", "_low", "_named", "_at", "_runs", "_rest", "_listed", "_found").withColumn("text", F.col("text").cast("string"))
    found = with_candidates(given).withColumn("_found", F.expr(f"CASE WHEN size(_runs) > 0 THEN {_described('_listed')} END"))
    scored = f"transform(_found, f -> struct(f.text AS text, {forest_sql(forest, 'f')} AS score))"
    judged = f"transform({scored}, s -> struct(s.text AS text, s.score AS score, s.score >= {threshold}D AS secret))"
    found = found.withColumn("findings", F.expr(f"coalesce({judged}, array())"))
    shown = f"concat(array(_rest[0]), transform(findings, (f, i) -> concat(if(f.secret, {_sql_text(REDACTED)}, f.text), _rest[i + 1])))"
    redacted = F.expr(f"CASE WHEN exists(findings, f -> f.secret) THEN array_join({shown}, '') ELSE text END")
    return found.withColumn("redacted", redacted).drop("_runs", "_rest", "_listed", "_found")
