"""The registered queries once more as SQL, written apart from the Spark code.

The SQL goes other ways on purpose: windows and unnested tokens where the
library works inside the row, joins where it sums postings in place.
"""

from __future__ import annotations

from relaydesk.packs import languages as pack
from relaydesk.packs.languages import LANGUAGES
from relaydesk.packs.phrases import SUPPORT_PHRASES
from relaydesk.packs.support import SUPPORT

W = r"[\p{L}\p{N}_]"
N = r"[^\p{L}\p{N}_]"
S = r"[\s\v\x1C-\x1F\x{85}\pZ]"
NS = r"[^\s\v\x1C-\x1F\x{85}\pZ]"
LABELS = pack.LABELS


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def clean(x: str, urls: bool = True) -> str:
    out = f"regexp_replace(coalesce({x}, ''), '@{W}+', '', 'g')"
    if urls:
        out = f"regexp_replace({out}, 'https?://{NS}+', '', 'g')"
    return f"trim(regexp_replace({out}, '{S}+', ' ', 'g'))"


def words(x: str, least: int = 1) -> str:
    return f"regexp_extract_all(lower({x}), '{W}{{{least},}}')"


def hit(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q('(?s)' + pattern)})"


def whole(pattern: str) -> str:
    """A whole-word search without boundary shorthands."""
    return f"(?:^|{N}){pattern}(?:$|{N})"


# ---------------------------------------------------------------- conversations

RUNS = """
    turns AS (SELECT conv_id, turn, role, text FROM conversations WHERE role <> 'system'),
    changes AS (SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER w THEN 1 ELSE 0 END AS ch
                FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
    islands AS (SELECT *, sum(ch) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS run FROM changes),
    runs AS (SELECT conv_id, run, any_value(role) AS role, min(turn) AS first_turn, max(turn) AS last_turn,
                    count(*) AS n_turns, string_agg(text, ' ' ORDER BY turn) AS text
             FROM islands GROUP BY conv_id, run)"""
PAIRS = f"""{RUNS},
    pairs AS (SELECT conv_id, arg_min(text, first_turn) FILTER (role = 'user') AS inquiry,
                     arg_min(text, first_turn) FILTER (role = 'assistant') AS resolution
              FROM runs GROUP BY conv_id
              HAVING inquiry IS NOT NULL AND resolution IS NOT NULL)"""


def replies(limit: int | None = None) -> str:
    return f"""{PAIRS},
    cleaned AS (SELECT conv_id, {clean('inquiry', False)} AS customer_inquiry,
                       {clean('resolution', False)} AS support_resolution FROM pairs),
    kb AS (SELECT * FROM cleaned
           WHERE length(customer_inquiry) >= 15 AND length(support_resolution) >= 15
           QUALIFY row_number() OVER (PARTITION BY customer_inquiry ORDER BY conv_id) = 1
           ORDER BY conv_id{f' LIMIT {limit}' if limit else ''})"""


# ---------------------------------------------------------------- tf-idf and retrieval


def term_counts(source: str, key: str, text: str, name: str) -> str:
    """CTEs giving ``name``(key, term, tf): unigrams and bigrams of words of two or more characters."""
    return f"""
    {name}_w AS (SELECT {key}, {words(text, 2)} AS w FROM {source}),
    {name} AS (SELECT {key}, term, count(*) AS tf FROM (
        SELECT {key}, unnest(w) AS term FROM {name}_w
        UNION ALL
        SELECT {key}, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM {name}_w)
        GROUP BY {key}, term)"""


def vocabulary(counts: str, source: str, features: int) -> str:
    return f"""
    vocab AS (SELECT term, sum(tf)::BIGINT AS tf, count(*) AS df,
                     ln((1 + (SELECT count(*) FROM {source})) / (1.0::DOUBLE + count(*))) + 1 AS idf
              FROM {counts} GROUP BY term ORDER BY tf DESC, term LIMIT {features}),
    place AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_position, idf FROM vocab)"""


def weights(counts: str, key: str, sublinear: bool, name: str) -> str:
    tf = "(1 + ln(tf))" if sublinear else "tf"
    return f"""
    {name}_raw AS (SELECT {key}, term_position, term, {tf} * idf AS x FROM {counts} JOIN place USING (term)),
    {name} AS (SELECT {key}, term_position, term, x / sqrt(sum(x * x) OVER (PARTITION BY {key})) AS weight
               FROM {name}_raw)"""


def index(features: int = 5000, sublinear: bool = True) -> str:
    return ",".join(
        [
            replies(),
            term_counts("kb", "conv_id", "customer_inquiry", "kb_terms"),
            vocabulary("kb_terms", "kb", features),
            weights("kb_terms", "conv_id", sublinear, "kb_vec"),
        ]
    )


def ranked(source: str, key: str, text: str, sublinear: bool, own: bool = False) -> str:
    """CTE ``hits``(key, kb_id, score, rank) of a message source against ``kb_vec``."""
    other = f"WHERE v.conv_id <> m.{key}" if own else ""
    return ",".join(
        [
            term_counts(source, key, text, "msg_terms"),
            weights("msg_terms", key, sublinear, "msg_vec"),
            f"""
    sims AS (SELECT m.{key} AS key, v.conv_id AS kb_id, sum(m.weight * v.weight) AS score
             FROM msg_vec m JOIN kb_vec v USING (term_position) {other} GROUP BY 1, 2),
    hits AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY round(score, 9) DESC, kb_id) AS rank FROM sims)""",
        ]
    )


# ---------------------------------------------------------------- intent and escalation


def regression(source: str, key: str, text: str, label: str, asked: str, steps: int = 500, features: int = 2500) -> str:
    """CTE ``priors``(key, p_*): probabilities by a regression fitted on ``source``, for its column ``asked``.

    Accelerated gradient descent by a recursive CTE: a row of a step holds a term's (place -1: the intercepts')
    weights z and the point y that the gradient is taken at. No curvature is more than ``steep``, and none less than 1.
    """
    z, y = [f"z_{x}" for x in LABELS], [f"y_{x}" for x in LABELS]
    nothing = ", ".join(f"0.0::DOUBLE AS {c}" for c in [*z, *y])
    top = "greatest(" + ", ".join(f"CASE WHEN n_{x} > 0 THEN s_{x} END" for x in LABELS) + ")"
    # a label that no row has is no class
    e = {x: f"CASE WHEN n_{x} > 0 THEN exp(s_{x} - top) ELSE 0 END" for x in LABELS}
    total = " + ".join(e.values())
    moved = {x: f"(y_{x} - (g_{x} + CASE WHEN place < 0 THEN 0 ELSE y_{x} END) / steep)" for x in LABELS}
    return f"""
    {term_counts(source, key, text, "lr_terms")},
    lr_vocab AS (SELECT term, ln((1 + (SELECT count(*) FROM {source})) / (1.0::DOUBLE + count(*))) + 1 AS idf
                 FROM lr_terms GROUP BY term ORDER BY sum(tf) DESC, term LIMIT {features}),
    lr_place AS MATERIALIZED (SELECT term, row_number() OVER (ORDER BY term) - 1 AS place, idf FROM lr_vocab),
    lr_x AS MATERIALIZED (SELECT {key} AS key, place, x / sqrt(sum(x * x) OVER (PARTITION BY {key})) AS w
        FROM (SELECT {key}, place, (1 + ln(tf)) * idf AS x FROM lr_terms JOIN lr_place USING (term))
        UNION ALL SELECT {key}, -1, 1.0 FROM {source}),
    lr_n AS MATERIALIZED (SELECT {", ".join(f"count(*) FILTER ({label} = '{x}') AS n_{x}" for x in LABELS)} FROM {source}),
    lr_rows AS MATERIALIZED (SELECT {key} AS key, {label} AS label, count(*) OVER () /
            ((SELECT {" + ".join(f"(n_{x} > 0)::INT" for x in LABELS)} FROM lr_n) * count(*) OVER (PARTITION BY {label}))::DOUBLE AS row_weight
        FROM {source}),
    lr_steep AS MATERIALIZED (SELECT 1 + max(line) / 2 AS steep FROM (SELECT key, sum(x.w * m.w) AS line FROM lr_x x
        JOIN (SELECT place, sum(w * row_weight) AS w FROM lr_x JOIN lr_rows USING (key) GROUP BY place) m USING (place) GROUP BY key)),
    lr_fit AS (
        SELECT 0 AS step, place, {nothing} FROM (SELECT DISTINCT place FROM lr_x)
        UNION ALL (
        WITH sums AS (SELECT key, {", ".join(f"sum(w * y_{x}) AS s_{x}" for x in LABELS)} FROM lr_x JOIN lr_fit USING (place) GROUP BY key),
        topped AS (SELECT *, {top} AS top FROM sums CROSS JOIN lr_n),
        added AS (SELECT *, {total} AS total FROM topped),
        rest AS (SELECT key, {", ".join(f"row_weight * ({e[x]} / total - (label = '{x}')::INT) AS r_{x}" for x in LABELS)}
                 FROM added JOIN lr_rows USING (key)),
        slope AS (SELECT place, {", ".join(f"sum(w * r_{x}) AS g_{x}" for x in LABELS)} FROM lr_x JOIN rest USING (key) GROUP BY place),
        went AS (SELECT step + 1 AS step, place, (sqrt(steep) - 1) / (sqrt(steep) + 1) AS swing,
                 {", ".join(f"{moved[x]} AS new_{x}, z_{x}" for x in LABELS)}
                 FROM lr_fit JOIN slope USING (place) CROSS JOIN lr_steep WHERE step < {steps})
        SELECT step, place, {", ".join(f"new_{x}" for x in LABELS)}, {", ".join(f"new_{x} + swing * (new_{x} - z_{x})" for x in LABELS)} FROM went)),
    lr_model AS (SELECT * FROM lr_fit WHERE step = {steps}),
    {term_counts(source, key, asked, "lr_asked")},
    lr_a AS (SELECT key, place, x / sqrt(sum(x * x) OVER (PARTITION BY key)) AS w
        FROM (SELECT {key} AS key, place, (1 + ln(tf)) * idf AS x FROM lr_asked JOIN lr_place USING (term))
        UNION ALL SELECT {key}, -1, 1.0 FROM {source}),
    lr_sums AS (SELECT key, {", ".join(f"sum(w * z_{x}) AS s_{x}" for x in LABELS)} FROM lr_a JOIN lr_model USING (place) GROUP BY key),
    lr_top AS (SELECT *, {top} AS top FROM lr_sums CROSS JOIN lr_n),
    priors AS (SELECT key, {", ".join(f"{e[x]} / ({total}) AS p_{x}" for x in LABELS)} FROM lr_top)"""


PRIOR_TOP = "greatest(" + ", ".join(f"p_{x}" for x in LABELS) + ")"
PRIOR_NAME = "CASE " + " ".join(f"WHEN p_{x} = {PRIOR_TOP} THEN '{x}'" for x in LABELS) + " END"


def intent_of(source: str, key: str, text: str, fitted: bool = False) -> str:
    """CTE ``intents``(key, score_*, intent, intent_confidence) by rules alone, or by rules and ``priors``."""
    scores = ", ".join(
        f"1.5 * len(list_filter({words(text)}, lambda t: t IN ({', '.join(map(q, pack.LEXICONS[x]))}))) AS score_{x}"
        for x in LABELS
    )
    prior = {x: f"greatest(p_{x}, 1e-6::DOUBLE)" if fitted else "0.25::DOUBLE" for x in LABELS}
    logits = ", ".join(f"(ln({prior[x]}) + 1.2::DOUBLE * score_{x}) / 0.85::DOUBLE AS l_{x}" for x in LABELS)
    top = "greatest(" + ", ".join(f"l_{x}" for x in LABELS) + ")"
    total = " + ".join(f"exp(l_{x} - top)" for x in LABELS)
    name = " ".join(f"WHEN l_{x} = top THEN '{x}'" for x in LABELS)
    return f"""
    scored AS (SELECT {key} AS key, {scores}{", priors.* EXCLUDE (key)" if fitted else ""}
        FROM {source}{f" JOIN priors ON priors.key = {source}.{key}" if fitted else ""}),
    logits AS (SELECT *, {logits} FROM scored),
    topped AS (SELECT *, {top} AS top FROM logits),
    intents AS (SELECT *, CASE {name} END AS intent, 1.0::DOUBLE / ({total}) AS intent_confidence FROM topped)"""


def _decision(arms: list[tuple[str, str, float, str]], last: str) -> str:
    """Four CASE columns over (condition, reason, confidence, category) arms that escalate."""
    def case(pick, otherwise: str) -> str:
        return "CASE " + " ".join(f"WHEN {a[0]} THEN {pick(a)}" for a in arms) + f" ELSE {otherwise} END"

    return ", ".join(
        [
            case(lambda a: "true", "false") + " AS escalate",
            case(lambda a: "'ESCALATE'", "'AUTO_HANDLE'") + " AS decision_label",
            case(lambda a: q(a[1]), q(last)) + " AS stated_reason",
            case(lambda a: f"{a[2]}::DOUBLE", "0.91::DOUBLE") + " AS confidence",
            case(lambda a: q(a[3]), "'safe_self_service'") + " AS risk_category",
        ]
    )


_PORTABLE = {pack.REFUSAL: whole("(?:nicht|avec)")}


def tiered(x: str, intent: str) -> str:
    arms = [
        (hit(f"lower({x})", _PORTABLE.get(r.pattern, r.pattern)), r.reason, t.confidence, t.risk_category)
        for t in LANGUAGES.tiers
        for r in t.rules
    ]
    d = LANGUAGES.intent_default
    asked = f"({intent} = '{d.intent}' AND NOT {hit(f'lower({x})', whole('(?:para|pero)'))})"
    return _decision([*arms, (asked, d.reason, d.confidence, d.risk_category)], LANGUAGES.safe_reason)


def keyword(x: str) -> str:
    names = [k.replace(r"\b", "") for k in LANGUAGES.keywords]
    found = ", ".join(f"CASE WHEN {hit(f'lower({x})', whole(n))} THEN {q(n)} END" for n in names)
    listed = f"concat_ws(', ', {found})"
    return f"""{listed} <> '' AS escalate,
        CASE WHEN {listed} <> '' THEN 'ESCALATE' ELSE 'AUTO_HANDLE' END AS decision_label,
        CASE WHEN {listed} <> '' THEN 'Simple keyword match triggered: ' || {listed} || '.'
             ELSE 'No high-risk keyword found; routed to standard handling.' END AS stated_reason,
        CASE WHEN {listed} <> '' THEN 0.7::DOUBLE ELSE 0.65::DOUBLE END AS confidence,
        CASE WHEN {listed} <> '' THEN 'keyword_match' ELSE 'none' END AS risk_category"""


NEVER = """false AS escalate, 'AUTO_HANDLE' AS decision_label,
        'Default of the trivial variant: always auto-handle, text not inspected.' AS stated_reason,
        0.5::DOUBLE AS confidence, 'none' AS risk_category"""


def reply_case(intent: str, texts=LANGUAGES.replies) -> str:
    template = "CASE " + " ".join(f"WHEN {intent} = '{k}' THEN {q(v)}" for k, v in texts.templates.items())
    template += f" ELSE {q(texts.templates[texts.default_intent])} END"
    before, after = texts.specialist.split("%s")
    return f"""CASE
        WHEN risk_category = 'acute_safety' THEN {q(texts.safety)}
        WHEN risk_category = 'security_fraud' THEN {q(texts.security)}
        WHEN escalate AND {intent} = '{texts.repair_intent}' THEN {q(texts.repair)}
        WHEN escalate AND score > 0.40 THEN {q(texts.apology + ' ')} || resolution || {q(' ' + texts.step_in)}
        WHEN escalate THEN {q(texts.apology + ' ' + before)} || stated_reason || {q(after)}
        WHEN score >= 0.35 AND (contains(resolution, 'DM us') OR contains(lower(resolution), 'direct message'))
            THEN resolution
        WHEN score >= 0.35 THEN rtrim(resolution, '.') || {q('. ' + texts.offer)}
        ELSE {template} END"""


# ---------------------------------------------------------------- entities


def entity_list(x: str, patterns: tuple[str, ...]) -> str:
    found = ", ".join(f"trim(regexp_extract(lower({x}), {q(p)}))" for p in patterns)
    return f"array_to_string(list_sort(list_distinct(list_filter([{found}], lambda h: h <> ''))), '|')"


DEVICES = entity_list("text", LANGUAGES.devices)
OS = entity_list("text", LANGUAGES.os_versions)
DOCS = f"docs AS (SELECT doc_id, text, lang, {clean('text')} AS cleaned FROM documents)"
LABELLED = f"""labelled AS (SELECT doc_id, text, lang, n_chars, quality, toxic, toxic = 1 AS true_escalate,
        {clean('text')} AS cleaned FROM documents JOIN labels USING (doc_id))"""


def decided(source: str, key: str, text: str, fitted: bool = False) -> str:
    """CTE ``decided``: every row with intent and tiered escalation."""
    return f"""{intent_of(source, key, text, fitted)},
    decided AS (SELECT d.*, i.intent, i.intent_confidence, {tiered(f'd.{text}', 'i.intent')}
                FROM {source} d JOIN intents i ON i.key = d.{key})"""


FLAT = f"""doc_id, md5(cleaned) AS cleaned_md5, {DEVICES} AS devices, {OS} AS os_versions, intent,
        round(intent_confidence, 6) AS intent_confidence, escalate, stated_reason,
        round(confidence, 6) AS confidence, risk_category"""

TRIAGE = f"""WITH {index()}, {DOCS}, {decided('docs', 'doc_id', 'cleaned')},
    {ranked('docs', 'doc_id', 'cleaned', True)},
    best AS (SELECT key, score, support_resolution AS resolution FROM hits JOIN kb ON kb_id = conv_id WHERE rank = 1)
    SELECT {FLAT}, {reply_case('intent')} AS reply, 'proposed' AS system_mode
    FROM decided LEFT JOIN best ON key = doc_id"""

# ---------------------------------------------------------------- metrics

LABEL_LIST = "[" + ", ".join(map(q, LABELS)) + "]"
CLASSES = f"""labs AS (SELECT unnest({LABEL_LIST}) AS label),
    report AS (SELECT label,
        coalesce((SELECT count(*) FROM cases WHERE lang = label AND intent = label)::DOUBLE
                 / nullif((SELECT count(*) FROM cases WHERE intent = label), 0), 0) AS precision,
        coalesce((SELECT count(*) FROM cases WHERE lang = label AND intent = label)::DOUBLE
                 / nullif((SELECT count(*) FROM cases WHERE lang = label), 0), 0) AS recall,
        (SELECT count(*) FROM cases WHERE lang = label) AS support FROM labs),
    classes AS (SELECT label, precision, recall,
        coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1, support FROM report)"""
INTENT_CASES = f"""{DOCS}, {intent_of('docs', 'doc_id', 'cleaned')},
    cases AS (SELECT lang, intent FROM docs JOIN intents ON key = doc_id)"""

# ---------------------------------------------------------------- overlap

THINNED = """thinned AS (SELECT doc_id, text, regexp_replace(text, ' (?:the|of|de|la|der|in) ', ' ', 'g') AS hyp
        FROM documents)"""


def grams(source: str, key: str, hyp: str, ref: str, orders: tuple[int, ...]) -> str:
    """CTE ``bags``(key, n, hyp_n, ref_n, common) for the n-gram orders."""
    parts = []
    for side, text in (("h", hyp), ("r", ref)):
        for n in orders:
            gram = " || ' ' || ".join(f"w[i + {j}]" for j in range(n))
            parts.append(
                f"SELECT key, '{side}' AS side, {n} AS n, unnest(list_transform(range(1, len(w) - {n - 2}), "
                f"lambda i: {gram})) AS gram FROM (SELECT {key} AS key, {words(text)} AS w FROM {source})"
            )
    return f"""
    grams AS (SELECT key, n, gram, count(*) FILTER (side = 'h') AS h, count(*) FILTER (side = 'r') AS r
              FROM ({' UNION ALL '.join(parts)}) GROUP BY key, n, gram),
    bags AS (SELECT key, n, sum(h)::DOUBLE AS hyp_n, sum(r)::DOUBLE AS ref_n, sum(least(h, r))::DOUBLE AS common
             FROM grams GROUP BY key, n)"""


ROUGE = """
    rouge AS (SELECT key, n, CASE WHEN hyp_n > 0 AND ref_n > 0 AND common > 0
        THEN 2 * (common / hyp_n) * (common / ref_n) / (common / hyp_n + common / ref_n) ELSE 0 END AS f FROM bags)"""
BLEU = """
    bleu AS (SELECT key, CASE WHEN count(*) = 4 AND min(common) > 0 AND min(hyp_n) FILTER (n = 4) >= 1
            AND min(ref_n) FILTER (n = 4) >= 1
        THEN (CASE WHEN max(hyp_n) > max(ref_n) THEN 1 ELSE exp(1 - max(ref_n) / max(hyp_n)) END)
             * exp(avg(ln(common / nullif(hyp_n, 0))) FILTER (common > 0)) ELSE 0 END AS b
        FROM bags GROUP BY key)"""


def lcs(source: str, key: str, hyp: str, ref: str) -> str:
    """CTE ``lcs``(key, len, h, r): longest chain of matching positions rising on both sides.

    Matches are taken by hypothesis position, reference position falling; a
    patience row of smallest chain ends then grows to the length sought.
    """
    return f"""
    sides AS (SELECT {key} AS key, {words(hyp)} AS hw, {words(ref)} AS rw FROM {source}),
    hyp_at AS (SELECT key, unnest(hw) AS word, unnest(range(len(hw))) AS i FROM sides),
    ref_at AS (SELECT key, unnest(rw) AS word, unnest(range(len(rw))) AS j FROM sides),
    chains AS (SELECT key, list([j] ORDER BY i, j DESC) AS js FROM hyp_at JOIN ref_at USING (key, word) GROUP BY key),
    lcs AS (SELECT key, len(hw)::DOUBLE AS h, len(rw)::DOUBLE AS r, coalesce(len(list_reduce(js, lambda acc, e:
            list_concat(list_concat(list_filter(acc, lambda x: x < e[1]), e),
                        list_filter(acc, lambda x: x >= e[1])[2:]))), 0) AS len
            FROM sides LEFT JOIN chains USING (key)),
    rouge_l AS (SELECT key, CASE WHEN len > 0 THEN 2 * len / (h + r) ELSE 0 END AS f FROM lcs)"""


# ---------------------------------------------------------------- rubric


def marks(x: str, markers: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"contains({x}, {q(m)})::INT" for m in markers) + ")"


def rubric(source: str) -> str:
    """CTE ``rubric`` over (key, message, reply, gold, true_escalate, pred_escalate, intent)."""
    out, said = "lower(reply)", "lower(message)"
    tone = ("help", "sorry", "glad", "here to help", "dm us", "understand", "safety")
    action = ("settings >", "tap", "restart", "press", "support.apple.com", "iforgot", "visit", "go to")
    return f"""
    shares AS (SELECT *, {marks(out, tone)} AS tone, {marks(out, action)} AS action,
        len(list_intersect(list_distinct({words('gold', 4)}), list_distinct({words('reply', 4)})))::DOUBLE
        / greatest(len(list_distinct({words('gold', 4)})), 1) AS share FROM {source}),
    five AS (SELECT *,
        CASE WHEN share >= 0.4 THEN 5 WHEN share >= 0.25 THEN 4 WHEN share >= 0.12 THEN 3
             WHEN contains({out}, 'dm us') OR contains({out}, 'support.apple.com') THEN 3 ELSE 2 END::DOUBLE
             AS correctness_and_grounding,
        CASE WHEN tone >= 3 THEN 5 WHEN tone >= 1 THEN 4 ELSE 3 END::DOUBLE AS brand_tone_empathy,
        CASE WHEN action >= 2 OR (pred_escalate AND contains({out}, 'dm us')) THEN 5 WHEN action = 1 THEN 4
             ELSE 3 END::DOUBLE AS clarity_actionability,
        CASE WHEN true_escalate = pred_escalate THEN 5
             WHEN true_escalate AND (contains({said}, 'bulg') OR contains({said}, 'spark')) THEN 1
             WHEN true_escalate THEN 2 ELSE 3 END::DOUBLE AS escalation_appropriateness,
        CASE WHEN contains({out}, 'rice') AND contains({said}, 'rice') AND NOT contains({out}, 'don''t')
                  AND NOT contains({out}, 'cannot') THEN 1
             WHEN contains({out}, 'charge') AND (contains({said}, 'bulg') OR contains({said}, 'swollen')) THEN 1
             WHEN length(reply) > 350 THEN 4 ELSE 5 END::DOUBLE AS safety_conciseness FROM shares),
    rubric AS (SELECT *, round(0.3::DOUBLE * correctness_and_grounding + 0.2::DOUBLE * brand_tone_empathy
            + 0.2::DOUBLE * clarity_actionability + 0.2::DOUBLE * escalation_appropriateness
            + 0.1::DOUBLE * safety_conciseness, 2) AS composite_score,
        'Grounded response evaluated for ' || intent || '. Escalation match: '
            || CASE WHEN true_escalate = pred_escalate THEN 'True' ELSE 'False' END || '.' AS feedback FROM five)"""


RATED = f"""{LABELLED},
    rated AS (SELECT doc_id AS key, lang AS intent,
        CASE WHEN lang = 'de' THEN 'Bulging: ' || text ELSE text END AS message,
        array_to_string(list_filter(string_split(text, ' '),
            lambda w: length(w) < CASE WHEN lang = 'es' THEN 9 ELSE 6 END), ' ')
        || CASE lang WHEN 'en' THEN ' Sorry, we understand. DM us for help.'
                     WHEN 'fr' THEN ' Go to settings > language and tap it.'
                     WHEN 'de' THEN ' Do not charge it, visit us.' ELSE '' END AS reply,
        text AS gold, true_escalate, quality <> 1 AS pred_escalate,
        1.0::DOUBLE + 2.5::DOUBLE * quality + 1.5::DOUBLE * (1 - toxic) AS human_rating FROM labelled),
    {rubric('rated')}"""
STARS = """count(*) FILTER (composite_score >= 4.5) AS "5_stars",
        count(*) FILTER (composite_score >= 3.5 AND composite_score < 4.5) AS "4_stars",
        count(*) FILTER (composite_score >= 2.5 AND composite_score < 3.5) AS "3_stars",
        count(*) FILTER (composite_score >= 1.5 AND composite_score < 2.5) AS "2_stars",
        count(*) FILTER (composite_score < 1.5) AS "1_star\""""

# ---------------------------------------------------------------- agreement

RATERS = """raters AS (SELECT substring(o_orderpriority, 1, 1)::INT AS a,
        least(floor((substring(o_orderpriority, 1, 1)::INT * 100000 + o_totalprice) / 200000) + 1, 5)::INT AS b,
        substring(o_orderpriority, 1, 1)::INT * 0.5::DOUBLE + o_totalprice / 200000 AS x FROM orders)"""


def kappa(source: str, a: str, b: str, name: str = "kappa") -> str:
    """CTE ``name``(kappa) by the full grid of observed labels."""
    return f"""
    {name}_pairs AS (SELECT {a} AS a, {b} AS b, count(*)::DOUBLE AS n FROM {source} GROUP BY 1, 2),
    {name}_labels AS (SELECT v, row_number() OVER (ORDER BY v) AS i
        FROM (SELECT a AS v FROM {name}_pairs UNION SELECT b FROM {name}_pairs)),
    {name}_grid AS (SELECT p.i AS i, o.i AS j, power(p.i - o.i, 2) AS w,
        coalesce((SELECT sum(n) FROM {name}_pairs WHERE a = p.v AND b = o.v), 0) AS seen,
        coalesce((SELECT sum(n) FROM {name}_pairs WHERE a = p.v), 0) * coalesce((SELECT sum(n) FROM {name}_pairs
            WHERE b = o.v), 0) / (SELECT sum(n) FROM {name}_pairs) AS expected
        FROM {name}_labels p CROSS JOIN {name}_labels o),
    {name} AS (SELECT 1 - sum(w * seen) / nullif(sum(w * expected), 0) AS kappa FROM {name}_grid)"""


def mean_ranks(source: str, a: str, b: str) -> str:
    return f"""
    ranks AS (SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0::DOUBLE AS ra,
                     rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0::DOUBLE AS rb
              FROM {source})"""


def agreement(source: str, a: str, b: str) -> str:
    h, j = f"round_even({a}::DOUBLE, 0)::INT", f"round_even({b}::DOUBLE, 0)::INT"
    return f"""{kappa(source, h, j)}, {mean_ranks(source, a, b)}
    SELECT count(*) AS sample_size, round((SELECT kappa FROM kappa), 6) AS quadratic_weighted_kappa,
        round(corr({a}, {b}), 6) AS pearson_correlation,
        round((SELECT corr(ra, rb) FROM ranks), 6) AS spearman_correlation,
        round(avg(abs({a} - {b})), 6) AS "mean_absolute_error_MAE",
        round(avg(({h} = {j})::INT), 6) AS exact_agreement_rate,
        round(avg((abs({h} - {j}) <= 1)::INT), 6) AS within_1_point_agreement_rate,
        round(avg({a}), 6) AS human_mean_score, round(avg({b}), 6) AS judge_mean_score FROM {source}"""


def p_value(r: str, n: str) -> str:
    """Share of the density (1 - u^2)^((n - 4) / 2) of a correlation beyond |r|, by Simpson's rule."""
    def area(low: str) -> str:
        u = f"({low} + (1 - {low}) * i / 20000.0::DOUBLE)"
        return f"""((1 - {low}) * (SELECT sum((CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
            * power(greatest(1 - {u} * {u}, 0), ({n} - 4) / 2.0::DOUBLE)) FROM range(20001) t(i)))"""

    return f"({area(f'abs({r})')} / {area('0.0::DOUBLE')})"


# ---------------------------------------------------------------- comparison of variants

_CASE_WORDS = ", ".join(
    f"len(list_filter({words('resolution')}, lambda t: t IN ({', '.join(map(q, pack.LEXICONS[x]))}))) AS c_{x}"
    for x in LABELS
)
_CASE_TOP = "greatest(" + ", ".join(f"c_{x}" for x in LABELS) + ")"
_CASE_NAME = " ".join(f"WHEN c_{x} = {_CASE_TOP} THEN '{x}'" for x in LABELS)
CASES = f"""
    needed AS (SELECT conv_id, count(*) FILTER (role = 'user') AS n_user FROM runs GROUP BY conv_id),
    counted AS (SELECT *, {_CASE_WORDS} FROM pairs JOIN needed USING (conv_id)),
    cases AS (SELECT conv_id, inquiry AS customer_tweet, CASE {_CASE_NAME} END AS true_intent,
        n_user > 2 AS true_escalate, resolution AS gold, {clean('inquiry')} AS cleaned FROM counted)"""
def variants(fitted: bool) -> str:
    """CTEs of the scored answers of all variants; ``summary`` has a row for each."""
    learnt = regression("cases", "conv_id", "customer_tweet", "true_intent", "cleaned") + "," if fitted else ""
    name = f"(SELECT {PRIOR_NAME} FROM priors WHERE priors.key = c.conv_id)" if fitted else "'en'"
    return f"""WITH RECURSIVE {replies()}, {CASES}, {learnt}
    {term_counts('kb', 'conv_id', 'customer_inquiry', 'kb_terms')},
    {vocabulary('kb_terms', 'kb', 3000)},
    {weights('kb_terms', 'conv_id', False, 'kb_vec')},
    {ranked('cases', 'conv_id', 'cleaned', False, own=True)},
    simple_best AS (SELECT key, kb_id FROM hits WHERE rank = 1),
    simple AS (SELECT c.conv_id, {name} AS intent, {keyword('c.cleaned')},
        k.support_resolution AS reply
        FROM cases c LEFT JOIN simple_best b ON b.key = c.conv_id
        JOIN kb k ON k.conv_id = coalesce(b.kb_id, (SELECT min(conv_id) FROM kb))),
    p_vocab AS (SELECT term, sum(tf)::BIGINT AS tf, ln((1 + (SELECT count(*) FROM kb)) / (1.0::DOUBLE + count(*))) + 1 AS idf
        FROM kb_terms GROUP BY term ORDER BY tf DESC, term LIMIT 5000),
    p_kb AS (SELECT conv_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY conv_id)) AS weight
        FROM (SELECT conv_id, term, (1 + ln(t.tf)) * idf AS x FROM kb_terms t JOIN p_vocab USING (term))),
    p_msg AS (SELECT conv_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY conv_id)) AS weight
        FROM (SELECT conv_id, term, (1 + ln(t.tf)) * idf AS x FROM msg_terms t JOIN p_vocab USING (term))),
    p_sims AS (SELECT m.conv_id AS key, v.conv_id AS kb_id, sum(m.weight * v.weight) AS score
        FROM p_msg m JOIN p_kb v USING (term) WHERE m.conv_id <> v.conv_id GROUP BY 1, 2),
    p_best AS (SELECT key, score, support_resolution AS resolution FROM (SELECT *, row_number() OVER
        (PARTITION BY key ORDER BY round(score, 9) DESC, kb_id) AS rank FROM p_sims) JOIN kb ON kb_id = conv_id
        WHERE rank = 1),
    {decided('cases', 'conv_id', 'cleaned', fitted)},
    majority AS (SELECT true_intent FROM cases GROUP BY 1 ORDER BY count(*) DESC, min(conv_id) LIMIT 1),
    answers AS (
        SELECT 'trivial' AS system, conv_id, (SELECT true_intent FROM majority) AS pred_intent, false AS pred_escalate,
            {q(LANGUAGES.replies.canned)} AS reply FROM cases
        UNION ALL SELECT 'simple', conv_id, intent, escalate, reply FROM simple
        UNION ALL SELECT 'proposed', conv_id, intent, escalate, {reply_case('intent')} FROM decided
            LEFT JOIN p_best ON key = conv_id),
    full_answers AS (SELECT system || '|' || conv_id AS key, system, true_intent AS intent, pred_intent,
        customer_tweet AS message, reply, gold, true_escalate, pred_escalate FROM answers JOIN cases USING (conv_id)),
    {rubric('full_answers')},
    {grams('full_answers', 'key', 'reply', 'gold', (1, 2, 3, 4))}, {ROUGE}, {BLEU},
    {lcs('full_answers', 'key', 'reply', 'gold')},
    facts AS (SELECT a.*, coalesce(r1.f, 0) AS rouge1, coalesce(r2.f, 0) AS rouge2, coalesce(rl.f, 0) AS "rougeL",
        coalesce(b, 0) AS bleu4, intent = pred_intent AS right_intent FROM rubric a
        LEFT JOIN rouge r1 ON r1.key = a.key AND r1.n = 1 LEFT JOIN rouge r2 ON r2.key = a.key AND r2.n = 2
        LEFT JOIN rouge_l rl ON rl.key = a.key LEFT JOIN bleu ON bleu.key = a.key),
    per_class AS (SELECT system, label, count(*) FILTER (intent = label AND pred_intent = label)::DOUBLE AS hit,
        count(*) FILTER (intent = label)::DOUBLE AS support, count(*) FILTER (pred_intent = label)::DOUBLE AS predicted
        FROM facts CROSS JOIN (SELECT unnest({LABEL_LIST}) AS label) GROUP BY 1, 2),
    class_scores AS (SELECT system, label, coalesce(hit / nullif(predicted, 0), 0) AS class_precision,
        coalesce(hit / nullif(support, 0), 0) AS class_recall,
        coalesce(2 * hit / nullif(support + predicted, 0), 0) AS class_f1, support AS class_support FROM per_class),
    macro AS (SELECT system, avg(class_precision) AS macro_precision, avg(class_recall) AS macro_recall,
        avg(class_f1) AS macro_f1 FROM class_scores GROUP BY 1),
    counts AS (SELECT system, avg(right_intent::INT) AS intent_accuracy,
        avg((true_escalate = pred_escalate)::INT) AS escalation_accuracy,
        count(*) FILTER (true_escalate AND pred_escalate)::DOUBLE AS tp,
        count(*) FILTER (NOT true_escalate AND pred_escalate)::DOUBLE AS fp,
        count(*) FILTER (true_escalate AND NOT pred_escalate)::DOUBLE AS fn,
        count(*) FILTER (NOT true_escalate AND NOT pred_escalate)::DOUBLE AS tn,
        avg(rouge1) AS mean_rouge1, avg(rouge2) AS mean_rouge2, avg("rougeL") AS "mean_rougeL", avg(bleu4) AS mean_bleu4,
        avg(composite_score) AS mean_composite_score, stddev_pop(composite_score) AS std_composite_score, {STARS}
        FROM facts GROUP BY 1),
    summary AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
        coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
        coalesce(fn / nullif(fn + tp, 0), 0) AS "false_auto_handle_rate_FAHR",
        coalesce(fp / nullif(fp + tn, 0), 0) AS "false_escalation_rate_FER" FROM counts JOIN macro USING (system))"""


HEADLINE = ("macro_f1", "f1", "false_auto_handle_rate_FAHR", "mean_rougeL", "mean_composite_score")
SCALARS = {
    **{
        c: c
        for c in (
            "intent_accuracy", "macro_precision", "macro_recall", "macro_f1", "escalation_accuracy", "precision",
            "recall", "f1", "false_auto_handle_rate_FAHR", "false_escalation_rate_FER", "mean_rouge1", "mean_rouge2",
            "mean_rougeL", "mean_bleu4", "mean_composite_score", "std_composite_score",
            "5_stars", "4_stars", "3_stars", "2_stars", "1_star",
        )
    },
    "true_positives": "tp", "false_positives": "fp", "false_negatives": "fn", "true_negatives": "tn",
}
_METRIC_ROWS = " UNION ALL ".join(
    [f"SELECT system, '{m}' AS metric, '' AS label, round(\"{c}\"::DOUBLE, 6) AS value FROM summary" for m, c in SCALARS.items()]
    + [
        f"SELECT system, '{m}', label, round({m}::DOUBLE, 6) FROM class_scores"
        for m in ("class_precision", "class_recall", "class_f1", "class_support")
    ]
)

_SUPPORT = SUPPORT.replies
_HOT = whole("hot")

THREADS = f"""threads AS (SELECT doc_id, replace(replace(text, ', ', chr(10) || 'Customer: '), '. ',
            chr(10) || 'Support: ') AS thread FROM documents),
        split AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(thread, '^{S}+', ''), '{S}+$', ''), chr(10)) AS ls
            FROM threads),
        lines AS (SELECT doc_id, unnest(range(len(ls))) AS pos,
            unnest(list_transform(ls, lambda l: regexp_replace(regexp_replace(l, '^{S}+', ''), '{S}+$', ''))) AS line
            FROM split),
        marked AS (SELECT *, CASE WHEN starts_with(line, 'Customer:') THEN 'c' WHEN starts_with(line, 'Support:') THEN 's' END AS m
            FROM lines),
        spoken AS (SELECT *, last_value(m IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS who FROM marked),
        turned AS (SELECT *, CASE WHEN who IS DISTINCT FROM lag(who) OVER (PARTITION BY doc_id ORDER BY pos) THEN 1 ELSE 0 END AS ch
            FROM spoken),
        runs AS (SELECT *, sum(ch) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM turned),
        said AS (SELECT doc_id, run, any_value(who) AS who,
            string_agg(regexp_replace(line, '^(Customer|Support):{S}*', ''), ' ' ORDER BY pos) AS msg
            FROM runs WHERE who IS NOT NULL GROUP BY doc_id, run)"""
RULE_ROWS = ", ".join(
    f"({t}, {o}, {q(tier.risk_category)}, {q(rule.reason)})"
    for t, tier in enumerate(LANGUAGES.tiers)
    for o, rule in enumerate(tier.rules)
)

SQL: dict[str, str] = {
    "filter_project": "SELECT doc_id, lang, n_chars FROM documents WHERE source = 'src1'",
    "nonempty_pairs": f"""WITH {PAIRS}, c AS (SELECT conv_id, length({clean('inquiry', False)}) AS len_a,
        length({clean('resolution', False)}) AS len_b FROM pairs)
        SELECT * FROM c WHERE len_a >= 100 AND len_b >= 100""",
    "clean_text": f"""WITH t AS (SELECT 'd' || doc_id AS id, text FROM documents
        UNION ALL SELECT 'p' || page_id, url || chr(10) || html FROM pages)
        SELECT id, md5({clean('text')}) AS cleaned_md5, length({clean('text')}) AS cleaned_chars,
               md5({clean('text', False)}) AS kept_urls_md5 FROM t""",
    "extract_entities": f"""SELECT doc_id, {DEVICES} AS devices, {OS} AS os_versions,
        {DEVICES} <> '' AS has_device_info, {OS} <> '' AS has_os_info FROM documents""",
    "kb_from_threads": f"""WITH {THREADS}, pairs AS (SELECT doc_id,
            arg_min(msg, run) FILTER (who = 'c') AS inquiry, arg_min(msg, run) FILTER (who = 's') AS resolution
            FROM said GROUP BY doc_id HAVING inquiry IS NOT NULL AND resolution IS NOT NULL),
        cleaned AS (SELECT doc_id, {clean('inquiry', False)} AS customer_inquiry,
            {clean('resolution', False)} AS support_resolution FROM pairs)
        SELECT * FROM cleaned WHERE length(customer_inquiry) >= 15 AND length(support_resolution) >= 15
        QUALIFY row_number() OVER (PARTITION BY customer_inquiry ORDER BY doc_id) = 1""",
    "speaker_parse": f"""WITH {THREADS}
        SELECT doc_id, count(*) FILTER (who = 'c') AS n_customer, count(*) FILTER (who = 's') AS n_support,
            {clean("arg_min(msg, run) FILTER (who = 'c')", False)} AS inquiry,
            {clean("arg_min(msg, run) FILTER (who = 's')", False)} AS resolution
        FROM said GROUP BY doc_id HAVING n_customer > 0 AND n_support > 0""",
    "rule_usage": f"""WITH {DOCS}, {decided('docs', 'doc_id', 'cleaned')},
        rules(tier, ord, risk_category, reason) AS (VALUES {RULE_ROWS})
        SELECT tier::BIGINT AS tier, ord::BIGINT AS ord, r.risk_category, reason,
            (SELECT count(*) FROM decided WHERE stated_reason = reason) AS n FROM rules r""",
    "preprocess": f"""SELECT doc_id, md5(text) AS raw_md5, md5({clean('text')}) AS cleaned_md5, {DEVICES} AS devices,
        {OS} <> '' AS has_os_info FROM documents""",
    "word_tokens": f"""SELECT doc_id, len({words('text')}) AS n_tokens, md5(array_to_string({words('text')}, ' ')) AS tokens_md5
        FROM documents""",
    "speaker_runs": "WITH "
    + RUNS.replace("FROM conversations WHERE role <> 'system'", "FROM derived").replace(
        "turns AS",
        "derived AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' AND length(text) >= 1000 THEN 'long' "
        "ELSE 'short' END AS role, text FROM conversations), turns AS",
    )
    + " SELECT conv_id, run::BIGINT AS run, role, first_turn, last_turn, n_turns, md5(text) AS text_md5 FROM runs",
    "first_turns": f"WITH {PAIRS} SELECT conv_id, inquiry, resolution FROM pairs",
    "kb_build": f"WITH {replies()} SELECT * FROM kb",
    "limit_after_dedup": f"WITH {replies(50)} SELECT * FROM kb",
    "stream_kb_build": f"WITH {replies()} SELECT * FROM kb",
    "kb_json": f"WITH {replies()} SELECT * FROM kb",
    "dedup_keep_first": """SELECT doc_id, source, n_chars FROM documents
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
    "union_check": """SELECT count(*) AS n, 200::BIGINT AS expected FROM documents
        WHERE lang IN ('en', 'fr', 'de', 'es') HAVING count(*) <> 200""",
    "labelled_union": "SELECT doc_id, lang AS true_intent FROM documents WHERE lang IN ('en', 'fr', 'de', 'es')",
    "case_counts": """WITH c AS (SELECT lang, (toxic = 1) AS esc,
            CASE WHEN n_chars < 1000 THEN 'easy' WHEN n_chars < 4000 THEN 'medium' ELSE 'hard' END AS difficulty
            FROM documents JOIN labels USING (doc_id)),
        g AS (SELECT CASE WHEN grouping(lang) = 0 THEN 'intent' WHEN grouping(esc) = 0 THEN 'escalate' ELSE 'difficulty' END
                AS dimension, coalesce(lang, esc::VARCHAR, difficulty) AS value, count(*) AS n
            FROM c GROUP BY GROUPING SETS ((lang), (esc), (difficulty))),
        d(dimension, value) AS (VALUES ('escalate', 'true'), ('escalate', 'false'), ('difficulty', 'easy'),
            ('difficulty', 'medium'), ('difficulty', 'hard'), ('difficulty', 'none'))
        SELECT dimension, value, sum(n)::BIGINT AS n FROM (SELECT * FROM g UNION ALL SELECT dimension, value, 0 FROM d)
        GROUP BY 1, 2""",
    "majority_class": """SELECT doc_id, (SELECT lang FROM documents GROUP BY lang ORDER BY count(*) DESC, min(doc_id) LIMIT 1)
        AS intent, 0.5::DOUBLE AS intent_confidence FROM documents""",
    "rule_scores": f"WITH {DOCS}, {intent_of('docs', 'doc_id', 'cleaned')} SELECT key AS doc_id, "
    + ", ".join(f"score_{x}::DOUBLE AS score_{x}" for x in LABELS)
    + " FROM intents",
    "hybrid_intent": f"""WITH {DOCS}, {intent_of('docs', 'doc_id', 'cleaned')}
        SELECT key AS doc_id, intent, round(intent_confidence, 6) AS intent_confidence FROM intents""",
    "support_intent": f"""WITH h AS (SELECT p_partkey, {hit('lower(p_name)', _HOT)} AS hot FROM part)
        SELECT p_partkey, 'hardware_battery' AS intent, CASE WHEN hot
            THEN round(1 / (1 + 6 * exp(-1.8::DOUBLE / 0.85)), 6) ELSE round(1 / 7.0::DOUBLE, 6) END AS intent_confidence,
            'safe_self_service' AS risk_category, {q(_SUPPORT.templates['hardware_battery'])} AS reply FROM h""",
    "tfidf_vocabulary": f"""WITH {term_counts('documents', 'doc_id', 'text', 'terms')},
        {vocabulary('terms', 'documents', 2500)} SELECT term, tf, df, round(idf, 6) AS idf FROM vocab""",
    "tfidf_weights": f"""WITH {term_counts('documents', 'doc_id', 'text', 'terms')},
        {vocabulary('terms', 'documents', 2500)}, {weights('terms', 'doc_id', True, 'vec')}
        SELECT doc_id, term_position, round(weight, 6) AS weight FROM vec""",
    "trivial_escalation": f"SELECT doc_id, {NEVER} FROM documents",
    "keyword_escalation": f"WITH {DOCS} SELECT doc_id, {keyword('cleaned')} FROM docs",
    "tiered_escalation": f"""WITH {DOCS}, {decided('docs', 'doc_id', 'cleaned')}
        SELECT doc_id, escalate, decision_label, stated_reason, confidence, risk_category FROM decided""",
    "reply_vectors": f"WITH {index(3000, False)} SELECT conv_id AS kb_id, term_position, round(weight, 6) AS weight FROM kb_vec",
    "nearest_reply": f"""WITH {index(3000, False)}, {DOCS}, {ranked('docs', 'doc_id', 'cleaned', False)}
        SELECT doc_id, support_resolution AS reply FROM docs
        LEFT JOIN (SELECT * FROM hits WHERE rank = 1) ON key = doc_id
        JOIN kb ON conv_id = coalesce(kb_id, (SELECT min(conv_id) FROM kb))""",
    "topk_exemplars": f"""WITH {index()}, {DOCS}, {ranked('docs', 'doc_id', 'cleaned', True)}
        SELECT key AS doc_id, rank, kb_id, round(score, 6) AS score FROM hits WHERE rank <= 3""",
    "topk_other_threads": f"""WITH {index()}, q AS (SELECT conv_id, {clean('inquiry')} AS cleaned FROM pairs),
        {ranked('q', 'conv_id', 'cleaned', True, own=True)}
        SELECT key AS conv_id, rank, kb_id, round(score, 6) AS score FROM hits WHERE rank <= 3""",
    "reply_decision": f"""WITH {index()},
        said AS (SELECT conv_id * 1000000 + turn AS mkey, conv_id, turn, {clean('text')} AS cleaned FROM conversations
            WHERE role = 'user'),
        {decided('said', 'mkey', 'cleaned')}, {ranked('said', 'mkey', 'cleaned', True)},
        best AS (SELECT key, score, support_resolution AS resolution FROM hits JOIN kb ON kb_id = conv_id WHERE rank = 1)
        SELECT conv_id, turn, intent, escalate, risk_category, {reply_case('intent')} AS reply
        FROM decided LEFT JOIN best ON key = mkey""",
    "triage": TRIAGE,
    "stream_triage": TRIAGE,
    "stream_triage_joined": TRIAGE,
    "triage_simple": f"""WITH {index(3000, False)}, {DOCS}, {ranked('docs', 'doc_id', 'cleaned', False)},
        k AS (SELECT *, 'en' AS intent, 0.25::DOUBLE AS intent_confidence, {keyword('cleaned')} FROM docs)
        SELECT {FLAT}, support_resolution AS reply, 'simple' AS system_mode FROM k
        LEFT JOIN (SELECT * FROM hits WHERE rank = 1) ON key = doc_id
        JOIN kb ON conv_id = coalesce(kb_id, (SELECT min(conv_id) FROM kb))""",
    "triage_trivial": f"""WITH {DOCS}, k AS (SELECT *, (SELECT lang FROM documents GROUP BY lang
            ORDER BY count(*) DESC, min(doc_id) LIMIT 1) AS intent, 0.5::DOUBLE AS intent_confidence, {NEVER} FROM docs)
        SELECT {FLAT}, {q(LANGUAGES.replies.canned)} AS reply, 'trivial' AS system_mode FROM k""",
    "confusion_matrix": f"""WITH {INTENT_CASES}, labs AS (SELECT unnest({LABEL_LIST}) AS x)
        SELECT t.x AS true_label, p.x AS pred_label, (SELECT count(*) FROM cases WHERE lang = t.x AND intent = p.x) AS n
        FROM labs t CROSS JOIN labs p""",
    "class_report": f"""WITH {INTENT_CASES}, {CLASSES} SELECT label, round(precision, 6) AS precision,
        round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM classes""",
    "macro_report": f"""WITH {INTENT_CASES}, {CLASSES}
        SELECT round((SELECT avg((lang = intent)::INT) FROM cases), 6) AS accuracy,
        round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1
        FROM classes""",
    "escalation_report": f"""WITH {LABELLED}, {decided('labelled', 'doc_id', 'cleaned')},
        c AS (SELECT count(*) FILTER (true_escalate AND escalate) AS tp, count(*) FILTER (NOT true_escalate AND escalate) AS fp,
            count(*) FILTER (true_escalate AND NOT escalate) AS fn, count(*) FILTER (NOT true_escalate AND NOT escalate) AS tn
            FROM decided)
        SELECT round((tp + tn)::DOUBLE / (tp + fp + fn + tn), 6) AS accuracy,
            round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision,
            round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall,
            round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
            tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
            round(coalesce(fn::DOUBLE / nullif(fn + tp, 0), 0), 6) AS "false_auto_handle_rate_FAHR",
            round(coalesce(fp::DOUBLE / nullif(fp + tn, 0), 0), 6) AS "false_escalation_rate_FER" FROM c""",
    "rouge12": f"""WITH {THINNED}, {grams('thinned', 'doc_id', 'hyp', 'text', (1, 2))}, {ROUGE}
        SELECT doc_id, round(coalesce(a.f, 0)::DOUBLE, 6) AS rouge1, round(coalesce(b.f, 0)::DOUBLE, 6) AS rouge2
        FROM documents LEFT JOIN rouge a ON a.key = doc_id AND a.n = 1 LEFT JOIN rouge b ON b.key = doc_id AND b.n = 2""",
    "bleu4": f"""WITH {THINNED}, {grams('thinned', 'doc_id', 'hyp', 'text', (1, 2, 3, 4))}, {BLEU}
        SELECT doc_id, round(coalesce(b, 0)::DOUBLE, 6) AS bleu4 FROM documents LEFT JOIN bleu ON key = doc_id""",
    "overlap_means": f"""WITH {THINNED}, {grams('thinned', 'doc_id', 'hyp', 'text', (1, 2, 3, 4))}, {ROUGE}, {BLEU}
        SELECT round(avg(coalesce(x.f, 0)::DOUBLE), 6) AS mean_rouge1, round(avg(coalesce(y.f, 0)::DOUBLE), 6) AS mean_rouge2,
        round(avg(coalesce(z.b, 0)::DOUBLE), 6) AS mean_bleu4 FROM documents LEFT JOIN rouge x ON x.key = doc_id AND x.n = 1
        LEFT JOIN rouge y ON y.key = doc_id AND y.n = 2 LEFT JOIN bleu z ON z.key = doc_id""",
    "rouge_l": f"""WITH p AS (SELECT conv_id * 1000000 + turn AS pkey, conv_id, turn, s.text AS text, n.text AS ref
            FROM conversations s JOIN (SELECT conv_id, turn - 1 AS turn, text FROM conversations) n USING (conv_id, turn)),
        {lcs('p', 'pkey', 'text', 'ref')}
        SELECT conv_id, turn, round(f::DOUBLE, 6) AS "rougeL" FROM p JOIN rouge_l ON key = pkey""",
    "rubric_scores": f"""WITH {RATED} SELECT key AS doc_id, correctness_and_grounding, brand_tone_empathy,
        clarity_actionability, escalation_appropriateness, safety_conciseness, composite_score, feedback FROM rubric""",
    "rubric_summary": f"""WITH {RATED} SELECT round(avg(composite_score), 6) AS mean_composite_score,
        round(stddev_pop(composite_score), 6) AS std_composite_score, {STARS} FROM rubric""",
    "weighted_kappa": f"WITH {RATERS}, {kappa('raters', 'a', 'b')} SELECT round(kappa, 6) AS kappa FROM kappa",
    "correlations": f"""WITH {RATERS}, {mean_ranks('raters', 'a', 'x')}
        SELECT round(corr(a, x), 6) AS pearson, round((SELECT corr(ra, rb) FROM ranks), 6) AS spearman FROM raters""",
    "agreement_summary": f"WITH {RATERS}, {agreement('raters', 'a', 'x')}",
    "p_values": f"""WITH {LABELLED}, pv AS (SELECT quality AS a, n_chars / 1000.0::DOUBLE AS x FROM labelled),
        {mean_ranks('pv', 'a', 'x')},
        c AS (SELECT count(*) AS n, corr(a, x) AS r, (SELECT corr(ra, rb) FROM ranks) AS rho FROM pv)
        SELECT n AS sample_size, round({p_value('r', 'n')}, 6) AS pearson_p_value,
            round({p_value('rho', 'n')}, 6) AS spearman_p_value FROM c""",
    "calibration": f"WITH {RATED}, {agreement('rubric', 'human_rating', 'composite_score')}",
    "system_comparison": variants(False)
    + "SELECT system, "
    + ", ".join(f'round("{c}", 6) AS "{c}"' for c in HEADLINE)
    + " FROM summary",
    "system_metrics": f"{variants(False)} {_METRIC_ROWS}",
    "cases_csv": f"WITH {LABELLED} SELECT doc_id, md5(text) AS text_md5, lang, true_escalate FROM labelled",
}
SQL["topk_exemplars_joined"] = SQL["topk_exemplars"]
SQL["cases_json"] = SQL["cases_csv"]
SQL["lr_intent"] = f"""WITH RECURSIVE {DOCS}, {regression('docs', 'doc_id', 'text', 'lang', 'cleaned')}
    SELECT doc_id, lang, {PRIOR_NAME} AS intent, round({PRIOR_TOP}, 4) AS intent_confidence FROM docs JOIN priors ON key = doc_id"""
SQL["lr_distribution"] = f"""WITH RECURSIVE {DOCS}, {regression('docs', 'doc_id', 'text', 'lang', 'cleaned', features=300)}
    {" UNION ALL ".join(f"SELECT key AS doc_id, '{x}' AS label, round(p_{x}::DOUBLE, 4) AS prob FROM priors" for x in LABELS)}"""
SQL["fitted_hybrid_intent"] = f"""WITH RECURSIVE {DOCS}, {regression('docs', 'doc_id', 'text', 'lang', 'cleaned')},
    {intent_of('docs', 'doc_id', 'cleaned', fitted=True)}
    SELECT doc_id, lang, intent, round(intent_confidence, 4) AS intent_confidence FROM docs JOIN intents ON key = doc_id"""
SQL["system_comparison_fitted"] = (
    f"{variants(True)} SELECT system, " + ", ".join(f'round("{c}", 4) AS "{c}"' for c in HEADLINE) + " FROM summary"
)


def _support(phrases: tuple[str, ...]) -> tuple[str, str]:
    """SQL of the support pack on part names with phrases: decisions, and hits by rule. Texts are ASCII, as RE2's boundaries are."""
    listed = "[" + ", ".join(map(q, phrases)) + "]"
    pick = lambda at: f"{listed}[({at}) % {len(phrases)} + 1]"
    t = "lower(cleaned)"
    messages = f"""raw AS (SELECT p_partkey, p_name || ': ' || {pick('p_partkey')} || CASE WHEN p_partkey % 3 = 0
            THEN ' and ' || {pick('p_partkey * 7 + 3')} ELSE '' END AS text FROM part),
        msgs AS (SELECT *, {clean('text')} AS cleaned FROM raw)"""
    labels, d = SUPPORT.labels, SUPPORT.intent_default
    scores = ", ".join(
        "1.5::DOUBLE * (" + " + ".join(f"len(regexp_extract_all({t}, {q(p)}))" for p in SUPPORT.intent_rules[x]) + f") AS s_{x}"
        for x in labels
    )
    logits = ", ".join(f"(ln(1 / 7.0::DOUBLE) + 1.2::DOUBLE * s_{x}) / 0.85::DOUBLE AS l_{x}" for x in labels)
    top = "greatest(" + ", ".join(f"l_{x}" for x in labels) + ")"
    total = " + ".join(f"exp(l_{x} - top)" for x in labels)
    name = "CASE " + " ".join(f"WHEN l_{x} = top THEN '{x}'" for x in labels) + " END"
    arms = [
        (hit(t, r.pattern), r.reason, tier.confidence, tier.risk_category) for tier in SUPPORT.tiers for r in tier.rules
    ]
    asked = f"(intent = '{d.intent}' AND NOT {hit(t, d.unless)})"
    shown = {k: k.replace(r"\b", "").replace("(?:ed)?", "") for k in SUPPORT.keywords}
    words_hit = "concat_ws(', ', " + ", ".join(f"CASE WHEN {hit(t, k)} THEN {q(n)} END" for k, n in shown.items()) + ")"
    decisions = f"""WITH {messages}, scored AS (SELECT *, {scores} FROM msgs), logits AS (SELECT *, {logits} FROM scored),
        topped AS (SELECT *, {top} AS top FROM logits),
        named AS (SELECT *, {name} AS intent, 1 / ({total}) AS intent_confidence, {words_hit} AS keywords FROM topped)
        SELECT p_partkey, {entity_list('text', SUPPORT.devices)} AS devices, {entity_list('text', SUPPORT.os_versions)} AS os_versions,
            intent, round(intent_confidence, 6) AS intent_confidence, keywords <> '' AS keyword_escalate,
            CASE WHEN keywords <> '' THEN 'Simple keyword match triggered: ' || keywords || '.'
                 ELSE 'No high-risk keyword found; routed to standard handling.' END AS keyword_reason,
            {_decision([*arms, (asked, d.reason, d.confidence, d.risk_category)], SUPPORT.safe_reason)} FROM named"""
    kinds = {
        "tier": [r.pattern for tier in SUPPORT.tiers for r in tier.rules],
        "keyword": SUPPORT.keywords,
        "intent": [p for x in labels for p in SUPPORT.intent_rules[x]],
        "device": SUPPORT.devices,
        "os_version": SUPPORT.os_versions,
    }
    counted = " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, {i}::BIGINT AS rule, count(*) FILTER ({hit(t, p)}) AS n_hits, "
        f"count(*) FILTER (NOT {hit(t, p)}) AS n_misses FROM msgs"
        for kind, patterns in kinds.items()
        for i, p in enumerate(patterns)
    )
    return decisions, f"WITH {messages} {counted}"


SQL["support_policy"], SQL["support_rule_hits"] = _support(SUPPORT_PHRASES)
# what was saved gives what was not
SQL["triage_from_saved"] = SQL["triage"]
SQL["saved_index_merged"] = SQL["topk_exemplars"]
SQL["lr_from_saved"] = SQL["lr_intent"]
