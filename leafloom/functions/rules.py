"""Fixed values of the document rules: patterns, word lists, weights and names that results must agree on.

The operators take them as parameters; these are the defaults for the Korean manual that the rules were made for.
"""

# Page labels, headings and lines.
PAGE_LABEL = r"(?i)^-\s*([ivxlcdm]+|\d{1,4})\s*-$"
STRUCTURAL_HEADING = r"^제\s*[\d-]+\s*(?:편|장|절)(?!\w)"
ARTICLE_LINE = r"^제\s*\d+(?:의\d+)?조(?:의\d+)?\("
DATE_LINE = r"^\d{4}년\s+\d{1,2}월\s+\d{1,2}일$"
RUNNING_HEADERS = (r"^2024\s+심판편람\s+제14판$", r"(?i)^Intellectual\s+Property\s+Trial\s+and$", r"(?i)^Appeal\s+Board$", r"^제\s+\d+\s+편$", r"^부\s*록$")
LAYOUT_HEADERS = (r"^심판편람\(제14판\)$", r"^목$", r"^차$")
FRAGMENT_HEADER = r"^(?:제|편|\d+|목|차)$"
MARGIN_FRAGMENT = r"^(?:제|편|장|절|\d+(?:\s*-\s*\d+)?)$"
LEADER_DOTS = r"(?:[·.]\s*){5,}"
TRAILING_PAGE_NUMBER = r"(?i)(?:\b\d{1,4}\b|[ivxlcdm]{1,12})\)?$"
ROUND_BULLET = r"^[oO](?:\s+|$)"
LIST_MARKER = r"^(?:\d+[.)]|[가-힣][.)]|[(（]\d+[)）]|[(（][가-힣IVXLC]{1,3}[)）]|[①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮]|[⑴⑵⑶⑷⑸⑹⑺⑻⑼⑽]|[※•◦▪■□▶☞◆◇○●∘]|[A-Za-z][.)]|[oO])(?:\s+|$)"
SENTENCE_END = r"[.!?…:]$"
SPECIAL_HEADING = r"^(?:[\[【].+[】\]]|<\s*.+\s*>)$"
BOXED_HEADING = r"^[\[【].+[】\]]$"
ANGLE_HEADING = r"^<\s*.+\s*>$"
FRAGMENT_PARAGRAPH = r"^(?:제|편|\d+)$"
TABLE_CELLS = r"\s+\|\s+"
BODY_FIRST_CELL = r"^(?:\d{2,4}|[A-Z]{1,6}|[①-⑳⑴-⑽㈎-㈞ⓅⓊⒹⒺⓉⓈ])$"
TOC_MARKER = r"목\s*차"
PART_TITLE = r"^(제\s*[\d-]+\s*편)\s*(.+)$"
CHAPTER_TITLE = r"^(제\s*\d+\s*장)\s*(.+)$"
SECTION_TITLE = r"^(제\s*\d+\s*절)\s*(.+)$"
TOKEN = r"[0-9A-Za-z가-힣§().·ㆍ~∼-]+"
BOUNDARY_REASONS = ("page-start", "gap", "indent", "style-change", "list-marker", "toc-entry", "table-row", "override", "page-merge")

# Words beside a line break.
SUFFIX_TOKENS = ("가", "게", "고", "과", "는", "니", "다", "도", "를", "로", "만", "며", "면", "서", "에", "와", "은", "을", "의", "이")
SUFFIX_PREFIXES = ("로서", "로써", "로부터", "에게", "에게서", "에서", "에는", "으로", "으로서", "으로써", "으로부터")
LEFT_STANDALONE = ("각", "그", "및", "이", "장", "저", "제", "절", "쪽", "편", "한")
COMPOUND_HEADS = ("감", "부", "사")
RIGHT_STANDALONE = ("것", "그", "등", "바", "수", "시", "장", "저", "점", "절", "전", "쪽", "편", "후", "호")
COMPOUND_TAILS = ("관", "인")
PARTICLE_ENDINGS = ("가", "는", "도", "를", "로", "와", "은", "을", "의", "이", "에", "과")

# Words that a line break has split, and what they are.
REPAIRS = (
    (r"산업재\s+산권", "산업재산권"),
    (r"특별행정\s+심판", "특별행정심판"),
    (r"행정\s+심판", "행정심판"),
    (r"국선대리\s+인", "국선대리인"),
    (r"법정대리\s+인", "법정대리인"),
    (r"소송대리\s+인", "소송대리인"),
    (r"특허관리\s+인", "특허관리인"),
    (r"무효처\s+분", "무효처분"),
    (r"특\s+허", "특허"),
    (r"심\s+판", "심판"),
    (r"청\s+구", "청구"),
    (r"처\s+분", "처분"),
    (r"또\s+는", "또는"),
    (r"의\s+하여", "의하여"),
    (r"말\s+한다", "말한다"),
    (r"대\s+리인", "대리인"),
    (r"대리\s+인", "대리인"),
    (r"심판\s+원장", "심판원장"),
    (r"심판\s+원", "심판원"),
    (r"심판\s+관", "심판관"),
    (r"심판\s+기관", "심판기관"),
    (r"심판\s+절차", "심판절차"),
    (r"심판\s+청구", "심판청구"),
    (r"심판\s+합의체", "심판합의체"),
    (r"특허\s+심판", "특허심판"),
    (r"청구\s+인", "청구인"),
    (r"피\s+청구인", "피청구인"),
    (r"특허\s+법", "특허법"),
    (r"상표\s+법", "상표법"),
    (r"실용신안\s+법", "실용신안법"),
    (r"민사소송\s+법", "민사소송법"),
    (r"행정소송\s+법", "행정소송법"),
    (r"이\s+에(?=\s+(?:대한|대해|따른|관한|의한|따라))", "이에"),
)

# Keyword classes in order.
CATEGORIES = (
    ("party", ("당사자", "청구인", "피청구인", "대리인", "참가인", "심판관", "특허권자", "상표권자", "사용권자", "권리자")),
    ("timing", ("기간", "시기", "기산", "만료", "연장", "정지", "승계")),
    ("evidence", ("증거", "증인", "감정", "검증", "문서", "신문", "심문", "석명", "사실조회")),
    ("criteria", ("요건", "기준", "판단", "효력", "효과", "성격", "범위", "대상", "원인", "사유", "유형", "종류")),
    ("case", ("사례", "판례", "예시")),
    ("procedure", ("절차", "처리", "진행", "청구", "신청", "취하", "송달", "보정", "접수", "심리", "심결", "결정", "기재", "제출", "통지", "설명회", "병합", "분리", "수리", "반려", "반환")),
    ("appendix", ("서식", "개정내용", "기준일 안내")),
)
APPENDIX_PART = "부 록"
CATEGORY_LABELS = {
    "related-law": "관련 법령",
    "party": "주체",
    "requirements": "적용 요건",
    "caution": "유의사항",
    "timing": "판단 시점",
    "evidence": "증거",
    "criteria": "판단 기준",
    "case": "사례·예시",
    "supplement": "보충자료",
    "procedure": "절차",
    "appendix": "부록",
}

# Flags of a page, their weights, and those that touch accuracy.
FLAG_WEIGHTS = {
    "missing-table-crop": 100,
    "synthetic-table-remains": 95,
    "multi-section-page": 68,
    "low-confidence": 80,
    "has-override": 75,
    "page-merge": 70,
    "korean-linebreak-residue": 67,
    "structural-fragment-paragraph": 65,
    "boxed-heading": 50,
    "angle-heading": 45,
}
ACCURACY_FLAGS = ("missing-table-crop", "synthetic-table-remains", "multi-section-page", "low-confidence", "has-override", "page-merge", "korean-linebreak-residue", "structural-fragment-paragraph")

# Queries, export policy and published files.
FIXED_QUERIES = ("머리말", "일러두기", "부 록", "부칙", "별첨", "개정 연혁", "지리적 표시", "FTA", "재검토기한")
ALWAYS_INCLUDED = ("front-preface", "front-notes")
ALWAYS_EXCLUDED = ("cover-and-masthead", "editorial-board")
EXCLUDED_PARTS = ("부 록", "후면부")
SKIPPED_SECTIONS = ("part-intro",)

# Bands of lines, columns and table regions, in points.
BAND_SLACK, COLUMN_GAP = 3.0, 18.0
SHORT_BAND, SHORT_WIDTH, SHORT_SHARE = 48, 180.0, 0.5
#: (short only, least left: share of width and offset from the left edge, most right: edge, share and offset, own width as a share: from, to)
CONTINUATIONS = (
    (False, 0.0, -8.0, "right", 0.0, 18.0, 0.0, 0.55),
    (True, -0.35, 0.0, "left", 0.18, 0.0, 0.0, None),
    (True, 0.0, -8.0, "left", 0.22, 0.0, 0.0, None),
    (False, 0.12, 0.0, "right", 0.0, 12.0, 0.35, None),
)
CENTER_OFFSET, CENTER_SHARE = 48.0, 0.2
DENSE_BANDS, DENSE_UP, DENSE_DOWN = 4, 32.0, 50.0
CHAIN_GAP, GROW_GAP, TAIL_GAP, TAIL_SHARE, TAIL_OFFSET = 42.0, 24.0, 18.0, 0.45, 12.0
GROW_LINES, GROW_SHARE, GROW_CENTER, REGION_PAD = 2, 0.65, 36.0, 12.0
CAPTION_OPENINGS = ("【", "[")

# The table of contents.
COVER_PAGES, FRONT_END = (1, 4), 12
FRONT_PART, BACK_PART = "전면부", "후면부"
FRONT_CHAPTERS = (("cover-and-masthead", "표지 및 발간정보"), ("front-preface", "머리말"), ("front-notes", "일러두기"))
BACK_CHAPTER = ("editorial-board", "심판편람편찬위원", "편찬위원")

# Chapters and their entries.
INTRO_SENTENCE = "이 편은 다음 장으로 구성됩니다."
OVERVIEW_TITLE, REVISION_TITLE = "개요", "개정 연혁"
REVISION_TERMS = "부 록 개정 연혁 개정내용"
HEADING_LEAD, HEADING_STOPS = 80, ".!?:"
UNKNOWN_DATE = "미상"

# The export's notes.
EXPORT_NAME = "NotebookLM"
IMAGE_NOTE, IMAGE_WORD = "[이미지 생략: {}]", "이미지"
OMITTED_SECTION = "{title} section은 고위험 페이지 검토 항목 때문에 {name} v1에서 제외했습니다."
EXCLUDED_COVER = "표지성 전면부 콘텐츠라서 {name} v1에서 제외했습니다."
EXCLUDED_BACK = "후면부 관리성 콘텐츠라서 {name} v1에서 제외했습니다."
EXCLUDED_APPENDIX = "부록은 표/서식 의존도가 높아 {name} v1에서 제외했습니다."
EXCLUDED_RISKY = "고위험 페이지가 있으나 section heading이 없어 chapter 전체를 {name} v1에서 제외했습니다."
KEPT_RISKY = "전면부 포함 정책에 따라 QA 위험 페이지가 있어도 chapter 전체를 유지했습니다."
NO_BODY = "{name} v1에서 포함 가능한 본문이 없습니다."
NO_CHAPTERS = "이 편은 {name} v1에서 포함 가능한 장이 없습니다. 제외 사유는 위 목록을 참고하세요."

# Special sections, their terms, and a page comparison's limits.
SPECIAL_GROUPS = ("front_preface", "front_notes", "toc", "part_intro", "revision_history", "legend", "appendix", "reconsideration_deadline", "fta_gi")
SPECIAL_TERMS = (("appendix", "부칙"), ("appendix", "별첨"), ("reconsideration_deadline", "재검토기한"), ("fta_gi", "지리적 표시"), ("fta_gi", "FTA"))
QUERY_GROUPS = ("front_preface", "front_notes", "part_intro", "revision_history", "appendix")
LIMITS_ALWAYS = (
    "PDF-side text comes from repaired page-review paragraphs, not OCR or browser text.",
    "Rendered-side text comes from overlapping non-search-alias search entries, not page-exact browser extraction.",
    "document-data HTML checks are coarse evidence only and do not prove exact page-to-HTML alignment.",
)
LIMIT_NO_CANDIDATE = "No overlapping non-search-alias search entries were available for this page."
LIMIT_MANY = "Multiple overlapping non-search-alias sections make attribution ambiguous for this page."
LIMIT_NO_CHAPTER = "Representative chapter HTML was not found in document-data."
LIMIT_NO_SECTION = "Representative section marker was not found in chapter HTML, so section evidence is coarse only."
LIMIT_SECTIONS = "This page is flagged as multi-section-page, so page-level attribution remains ambiguous even when a representative section is available."
LIMIT_MERGED = "This page is flagged for page-merge behavior, so page-level fidelity cannot be treated as page-exact."

# The text of a bundle's ledger; names in braces are filled in.
LEDGER = """# PDF ↔ Web Audit R2 Bundle ({bundle})

## 1. Bundle mode

- mode: offline derived bundle
- source of truth: `data/generated/`
- manual/browser evidence: not regenerated here; any manual verification remains manual-only
{baseline}
## 2. Coverage summary

- page count: `{pages}`
- delivery modes: `reader-body {reader_body}`, `toc-transform {toc_transform}`, `search-only {search_only}`
- text pages not exposed: `{hidden_text_pages}`
- uncovered body pages: `{uncovered_body_pages}`
- toc span: `{toc_span}`

## 3. Special sections

{special_sections}

## 4. Offline search artifacts

- search corpus entries: `{entries}`
- query count: `{queries}`
- matched queries: `{matched}`
- empty queries: `{empty}`
- `search-checks.json` contains the offline top-match summary for the fixed query set.

## 5. First-pass content fidelity diff

- compared pages: `{compared}`
- residue pages included: `{residue}`
- sampled high-risk prose pages: `{sampled}`
- statuses: `candidate-backed {backed}`, `ambiguous {ambiguous}`, `unsupported {unsupported}`
- sampled high-risk token loss rate: `{loss}`
- `content-fidelity-diff.json` compares repaired page-review paragraph text to overlapping non-alias search-entry text, with only coarse chapter/section HTML evidence.

## 6. Regression diff

- changed artifacts vs baseline: `{changed}`
- unchanged artifacts vs baseline: `{unchanged}`
- baseline-missing artifacts: `{missing}`

## 7. Generated files

{files}

## 8. Manual verification status

- Browser screenshots, navigation checks, and other manual evidence are intentionally not synthesized in this offline R2 bundle.
- If a previous manually verified bundle exists, treat it as manual evidence only rather than as regenerated proof.
"""
ARTIFACTS = ("page-coverage-ledger.json", "special-sections.json", "content-fidelity-diff.json", "regression-diff.json", "search-corpus.json", "search-results.json", "search-checks.json", "ledger.md")

# Page layouts and paragraphs, in lines, shares, points and characters.
DECORATIVE_LINES, DECORATIVE_SHARE, PROSE_RUN = 8, 0.5, 3
TOC_LEADERS, TOC_NUMBERS = 0.45, 0.35
TABLE_BANDS, BULLET_LINES = 5, 12
LIST_MARKERS, LIST_SHARE, LIST_LEADERS = 3, 0.3, 0.25
LONGEST_PARAGRAPH, LEAST_CUT, LEAST_ENTRY, ANCHOR_SLACK = 900, 180, 160, 6
