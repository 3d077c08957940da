"""Lists, patterns and thresholds that results are defined by."""

# Column names accepted in retail extracts, old name -> canonical name.
RETAIL_ALIASES = {
    "InvoiceNo": "Invoice",
    "UnitPrice": "Price",
    "CustomerID": "Customer ID",
}

# Canonical retail columns.
RETAIL_COLUMNS = [
    "Invoice",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "Price",
    "Customer ID",
    "Country",
]

# Stock codes (upper case) that are not products, by category.
STOCK_CODE_LISTS = {
    "postage_carriage_dotcom": ["POST", "DOT", "C2"],
    "discount": ["D"],
    "manual_adjustment": ["M", "ADJUST", "ADJUST2"],
    "fees_commission_bad_debt": ["BANK CHARGES", "AMAZONFEE", "CRUK", "B"],
    "sample_test_internal": ["S", "TEST001", "TEST002", "PADS"],
}
# Stock code prefixes by category.
STOCK_CODE_PREFIXES = {"gift_voucher": "GIFT", "sample_test_internal": "DCGS"}
# Fixed value: shape of a product code.
PRODUCT_CODE_PATTERN = r"^\p{Nd}+[A-Z]*\z"
PRODUCT_LIKE = "product_like"
OTHER_CODE = "other_non_product_or_unknown"

# Line amount bins, right-closed.
AMOUNT_BINS = [0, 1, 5, 10, 20, 50, 100, 500, 1000]
AMOUNT_LABELS = ["0-1", "1-5", "5-10", "10-20", "20-50", "50-100", "100-500", "500-1k", "1k+"]

# Review taxonomy.
TAXONOMY = {
    "delivery": ["delay", "not_received", "tracking_issue"],
    "product": ["defective", "wrong_item", "poor_quality", "missing_parts"],
    "service": ["no_response", "refund_problem", "seller_attitude"],
    "payment": ["billing_issue", "refund_delay"],
    "general": ["negative_low_detail", "unclear"],
}

# Review thresholds.
LOW_SCORE_MAX = 3
SMALL_MAX_CHARS = 120
LARGE_MIN_CHARS = 160
COMPLEX_MARKER_MIN = 2
RETRY_MIN_CHARS = 100
MIN_CONFIDENCE = 0.70
EXCERPT_CHARS = 200
LOW_DETAIL_MAX_WORDS = 4

# Issue patterns (pattern, category, subcategory, confidence), tried on normalised text.
ISSUE_PATTERNS = [
    (r"\b(n[aã]o|nao|não)\s+(recebi|recebeu|chegou|entregaram|entregou)\b|produto\s+n[aã]o\s+entregue|pedido\s+n[aã]o\s+chegou", "delivery", "not_received", 0.95),
    (r"\b(ainda|ate|até).{0,25}\b(n[aã]o|nao|não)\s+(recebi|chegou)\b", "delivery", "not_received", 0.95),
    (r"\b(atraso|atrasado|demora|demorou|prazo|fora do prazo)\b", "delivery", "delay", 0.88),
    (r"\b(rastreamento|transportadora|correios|codigo de rastreio|código de rastreio)\b", "delivery", "tracking_issue", 0.82),
    (r"\b(defeito|defeituoso|quebrad[oa]|danificad[oa]|estragad[oa]|avariad[oa])\b", "product", "defective", 0.90),
    (r"\b(produto errado|item errado|modelo errado|veio errado|diferente do anuncio|diferente do anúncio|nao condiz|não condiz)\b", "product", "wrong_item", 0.88),
    (r"\b(qualidade ruim|baixa qualidade|inferior|mal acabado|fragil|frágil|pessima qualidade|péssima qualidade)\b", "product", "poor_quality", 0.86),
    (r"\b(faltou|faltando|veio sem|incompleto|somente 1|s[oó] recebi uma|s[oó] recebi um)\b", "product", "missing_parts", 0.86),
    (r"\b(sem resposta|nao respondeu|não respondeu|ningu[eé]m responde|atendimento|sac|suporte)\b", "service", "no_response", 0.84),
    (r"\b(reembolso|estorno|devolu[cç][aã]o|troca)\b", "service", "refund_problem", 0.82),
    (r"\b(cobran[cç]a|boleto|cart[aã]o|pagamento|cobrado)\b", "payment", "billing_issue", 0.80),
]
# For each issue pattern in turn, pieces of which every match holds at least one.
ISSUE_STEMS = [
    ["nao", "não"],
    ["nao", "não"],
    ["atras", "demor", "prazo"],
    ["rastre", "transportadora", "correios"],
    ["defeit", "quebrad", "danificad", "estragad", "avariad"],
    ["errado", "diferente", "condiz"],
    ["qualidade", "inferior", "mal acabado", "fragil", "frágil"],
    ["falt", "veio sem", "incompleto", "somente 1", "recebi um"],
    ["respo", "atendimento", "sac", "suporte"],
    ["reembolso", "estorno", "devolu", "troca"],
    ["cobra", "boleto", "cart", "pagamento"],
]
# Fixed value: no match of the two patterns on whole texts is longer.
WHOLE_TEXT_MAX_CHARS = 40
# Whole texts that say little.
LOW_INFORMATION_PATTERN = r"^(ruim|pessimo|péssimo|horrivel|horrível|regular|ok|nao gostei|não gostei|nao recomendo|não recomendo|insatisfeito|decepcionado)\.?$"
# Whole texts that contradict a low score.
POSITIVE_PATTERN = r"^(bom|boa|muito bom|ótimo|otimo|excelente|recomendo|entrega no prazo|ok)\.?$"
# Words that signal several problems in one text.
COMPLEX_MARKER_PATTERN = r"\b(mas|por[eé]m|tamb[eé]m|al[eé]m|reembolso|troca|resposta|prazo|quebrad[oa]|faltou)\b"
# Words worth a second attempt with the larger model.
HIGH_VALUE_PATTERN = r"\b(reembolso|estorno|devolu[cç][aã]o|troca|sem resposta|atendimento|sac|suporte|cobran[cç]a|pagamento|produto errado|veio errado|diferente do anuncio|diferente do anúncio|defeito|quebrad[oa]|faltou|faltando)\b"

# Routes and result methods.
ROUTE_RULE = "rule"
ROUTE_SMALL = "small_llm"
ROUTE_LARGE = "large_llm"

# Confidences of the general rules and of the fallback.
EMPTY_CONFIDENCE = 0.75
POSITIVE_CONFIDENCE = 0.55
LOW_DETAIL_CONFIDENCE = 0.72
FALLBACK_CONFIDENCE = 0.50

# Token and cost formulas.
BATCH_TOKEN_BUDGET = 6000
SMALL_ITEM_OVERHEAD_TOKENS = 80
SMALL_MIN_OUTPUT_TOKENS = 200
SMALL_ITEM_OUTPUT_TOKENS = 120
LARGE_OVERHEAD_TOKENS = 180
LARGE_OUTPUT_TOKENS = 450
# Price of a million tokens in USD.
PRICE_PER_MILLION = {
    "small": {"input": 0.15, "output": 0.60},
    "large": {"input": 2.50, "output": 10.00},
}
DEFAULT_COST_CAP_USD = 3.0

# Views of the lines without a customer, as reported.
MISSING_CUSTOMER_BUCKETS = [
    "normal positive line: Quantity > 0 and Price > 0",
    "damage / inventory loss: Price = 0 and Quantity < 0",
    "zero-price positive quantity",
    "cancellation / return: C invoice",
    "bad debt: A invoice",
]

# Outcomes of a return, as reported.
RETURN_MATCHED = "matched_exact_prior_sale"
RETURN_UNMATCHED = "unmatched_no_exact_prior_sale"
RETURN_NOT_NEGATIVE = "not_eligible_non_negative_c_invoice"
RETURN_NO_CUSTOMER = "not_eligible_missing_customer_id"
RETURN_NO_PRODUCT = "not_eligible_non_product_stock_code"
RETURN_NO_PRICE = "not_eligible_non_positive_price"
RETURN_OTHER = "not_eligible_other"

# Names of line flags, as reported.
LINE_FLAGS = [
    "CustomerID_missing",
    "Description_missing",
    "Damage_inventory_loss",
    "Cancellation_C_invoice",
    "Bad_debt_A_invoice",
    "Non_product_stockcode",
    "Zero_price",
    "Negative_quantity",
    "Positive_product_sale",
]
# Names of invoice flags, and countries with a flag of their own.
INVOICE_FLAGS = ["all_missing", "any_dot", "any_damage", "any_non_product", "any_bad_debt", "large_basket_50plus"]
FLAGGED_COUNTRIES = {"UK": "United Kingdom", "Germany": "Germany", "France": "France", "EIRE": "EIRE"}
