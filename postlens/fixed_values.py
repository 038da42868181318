"""Word lists, patterns, tables and limits the results depend on."""

# ---- fixed values: salary ------------------------------------------------------------------
USD_TO_VND = 24_000
MILLION = 1_000_000
BAND_WIDTH_VND = 10_000_000
BAND_COUNT = 10  # closed bands below the open "Above" band
UNSPECIFIED_BAND = "Not Specified"
NEGOTIABLE_FOLDED = ("thoa thuan", "canh tranh", "negotiable")
TEXT_USD_TO_MILLION = 25 / 1000

# ---- fixed values: experience --------------------------------------------------------------
UNKNOWN = "Unknown"
# upper bound (exclusive), band, level
EXPERIENCE_STEPS = (
    (1, "0-1 year", "Intern / Fresher"),
    (3, "1-3 years", "Junior"),
    (5, "3-5 years", "Mid-level"),
    (8, "5-8 years", "Senior"),
)
EXPERIENCE_TOP = ("8+ years", "Lead / Principal")

# ---- fixed values: education, lowest level first -------------------------------------------
EDUCATION_WORDS = (
    ("College", ("cao đẳng", "college")),
    ("Bachelor", ("đại học", "bachelor")),
    ("Master", ("thạc sĩ", "master")),
    ("PhD", ("tiến sĩ", "phd")),
)

# ---- fixed values: work model and arrangement ----------------------------------------------
WORK_MODEL_WORDS = (
    ("Hybrid", ("hybrid", "lai")),
    ("Remote", ("remote", "từ xa")),
    ("On-Site", ("at office", "tại văn phòng", "on-site", "on site")),
)
WORK_ARRANGEMENT_WORDS = (
    ("Full-time", ("toàn thời gian", "full-time", "full time", "fulltime")),
    ("Part-time", ("bán thời gian", "part-time", "part time")),
    ("Internship", ("thực tập", "internship", "intern")),
)
# work model -> (group, sort order)
WORK_MODEL_GROUPS = {"On-Site": ("Office", 1), "Hybrid": ("Mixed", 2), "Remote": ("Offsite", 3)}
OTHER_PLACES = "nơi khác"
NEW_MARK = "(mới)"
NO_CATEGORY = "Others"
COUNTRY = "Vietnam"

# ---- fixed values: title pattern -> job category -------------------------------------------
CATEGORY_PATTERNS = (
    (r"(?i)\b(machine\s*learning|ml engineer|ml engineer)\b", "Machine Learning Engineer"),
    (
        r"(?i)\b(kỹ sư ai|nlp engineer|cv engineer|natural language processing engineer|kỹ sư công nghệ ai"
        r"|dev\s*ai|ai\s*developer|voice\s*ai|voiceai|ai platform engineer|ai integration engineer|ai\s*engineer"
        r"|artificial intelligence engineer|computer vision|cv engineer|llmops|nlp|genai)\b",
        "AI Engineer",
    ),
    (
        r"(?i)\b(data\s*&\s*ai scientist|ai scientist|data scientist|scientist dữ liệu|data science)\b",
        "Data Scientist",
    ),
    (
        r"(?i)\b(data warehouse engineer|etl engineer|elt egineer|database engineer|data platform engineer"
        r"|data platform|data engineer|big data engineer|kỹ sư dữ liệu|data pipeline)\b",
        "Data Engineer",
    ),
    (r"(?i)\b(analytics engineer|analytic engineer)\b", "Analytics Engineer"),
    (r"(?i)\b(bi engineer|business intelligence engineer|power\s*bi|tableau|looker)\b", "BI Engineer"),
    (
        r"(?i)\b(data analyst|business analyst|\bba\b|phân tích dữ liệu|phân tích nghiệp vụ|phân tích kinh doanh"
        r"|data analysis|data analytics|data operations analyst|master data analyst|data analyst[_\- ]?python"
        r"|python/sql)\b",
        "Data Analyst",
    ),
)

# ---- fixed values: location pattern, city code, city name, region --------------------------
CITY_PATTERNS = (
    (r"hồ\s*chí\s*minh|ho\s*chi\s*minh|hcmc|tphcm|hcm", "ho_chi_minh", "Ho Chi Minh City", "South"),
    (r"hà\s*nội|ha\s*noi|hanoi|hn", "ha_noi", "Ha Noi", "North"),
    (r"đà\s*nẵng|da\s*nang|danang|dn", "da_nang", "Da Nang", "Central"),
    (r"hải\s*phòng|hai\s*phong|haiphong|hp", "hai_phong", "Hai Phong", "North"),
    (r"cần\s*thơ|can\s*tho|cantho|ct", "can_tho", "Can Tho", "South"),
    (r"an\s*giang|angiang", "an_giang", "An Giang", "South"),
    (
        r"bà\s*rịa\s*[- ]?\s*vũng\s*tàu|ba\s*ria\s*vung\s*tau|brvt",
        "ba_ria_vung_tau",
        "Ba Ria - Vung Tau",
        "South",
    ),
    (r"bạc\s*liêu|bac\s*lieu", "bac_lieu", "Bac Lieu", "South"),
    (r"bắc\s*giang|bac\s*giang", "bac_giang", "Bac Giang", "North"),
    (r"bắc\s*kạn|bac\s*kan", "bac_kan", "Bac Kan", "North"),
    (r"bắc\s*ninh|bac\s*ninh", "bac_ninh", "Bac Ninh", "North"),
    (r"bến\s*tre|ben\s*tre", "ben_tre", "Ben Tre", "South"),
    (r"bình\s*định|binh\s*dinh", "binh_dinh", "Binh Dinh", "Central"),
    (r"bình\s*dương|binh\s*duong", "binh_duong", "Binh Duong", "South"),
    (r"bình\s*phước|binh\s*phuoc", "binh_phuoc", "Binh Phuoc", "South"),
    (r"bình\s*thuận|binh\s*thuan", "binh_thuan", "Binh Thuan", "Central"),
    (r"cà\s*mau|ca\s*mau", "ca_mau", "Ca Mau", "South"),
    (r"cao\s*bằng|cao\s*bang", "cao_bang", "Cao Bang", "North"),
    (r"đắk\s*lắk|dak\s*lak", "dak_lak", "Dak Lak", "Central"),
    (r"đắk\s*nông|dak\s*nong", "dak_nong", "Dak Nong", "Central"),
    (r"điện\s*biên|dien\s*bien", "dien_bien", "Dien Bien", "North"),
    (r"đồng\s*nai|dong\s*nai", "dong_nai", "Dong Nai", "South"),
    (r"đồng\s*tháp|dong\s*thap", "dong_thap", "Dong Thap", "South"),
    (r"gia\s*lai|gialai", "gia_lai", "Gia Lai", "Central"),
    (r"hà\s*giang|ha\s*giang", "ha_giang", "Ha Giang", "North"),
    (r"hà\s*nam|ha\s*nam", "ha_nam", "Ha Nam", "North"),
    (r"hà\s*tĩnh|ha\s*tinh", "ha_tinh", "Ha Tinh", "Central"),
    (r"hải\s*dương|hai\s*duong", "hai_duong", "Hai Duong", "North"),
    (r"hậu\s*giang|hau\s*giang", "hau_giang", "Hau Giang", "South"),
    (r"hòa\s*bình|hoa\s*binh", "hoa_binh", "Hoa Binh", "North"),
    (r"hưng\s*yên|hung\s*yen", "hung_yen", "Hung Yen", "North"),
    (r"khánh\s*hòa|khanh\s*hoa", "khanh_hoa", "Khanh Hoa", "Central"),
    (r"kiên\s*giang|kien\s*giang", "kien_giang", "Kien Giang", "South"),
    (r"kon\s*tum|kontum", "kon_tum", "Kon Tum", "Central"),
    (r"lai\s*châu|lai\s*chau", "lai_chau", "Lai Chau", "North"),
    (r"lâm\s*đồng|lam\s*dong", "lam_dong", "Lam Dong", "Central"),
    (r"lạng\s*sơn|lang\s*son", "lang_son", "Lang Son", "North"),
    (r"lào\s*cai|lao\s*cai", "lao_cai", "Lao Cai", "North"),
    (r"long\s*an|long\s*an", "long_an", "Long An", "South"),
    (r"nam\s*định|nam\s*dinh", "nam_dinh", "Nam Dinh", "North"),
    (r"nghệ\s*an|nghe\s*an", "nghe_an", "Nghe An", "Central"),
    (r"ninh\s*bình|ninh\s*binh", "ninh_binh", "Ninh Binh", "North"),
    (r"ninh\s*thuận|ninh\s*thuan", "ninh_thuan", "Ninh Thuan", "Central"),
    (r"phú\s*thọ|phu\s*tho", "phu_tho", "Phu Tho", "North"),
    (r"phú\s*yên|phu\s*yen", "phu_yen", "Phu Yen", "Central"),
    (r"quảng\s*bình|quang\s*binh", "quang_binh", "Quang Binh", "Central"),
    (r"quảng\s*nam|quang\s*nam", "quang_nam", "Quang Nam", "Central"),
    (r"quảng\s*ngãi|quang\s*ngai", "quang_ngai", "Quang Ngai", "Central"),
    (r"quảng\s*ninh|quang\s*ninh", "quang_ninh", "Quang Ninh", "North"),
    (r"quảng\s*trị|quang\s*tri", "quang_tri", "Quang Tri", "Central"),
    (r"sóc\s*trăng|soc\s*trang", "soc_trang", "Soc Trang", "South"),
    (r"sơn\s*la|son\s*la", "son_la", "Son La", "North"),
    (r"tây\s*ninh|tay\s*ninh", "tay_ninh", "Tay Ninh", "South"),
    (r"thái\s*bình|thai\s*binh", "thai_binh", "Thai Binh", "North"),
    (r"thái\s*nguyên|thai\s*nguyen", "thai_nguyen", "Thai Nguyen", "North"),
    (r"thanh\s*hóa|thanh\s*hoa", "thanh_hoa", "Thanh Hoa", "Central"),
    (r"thừa\s*thiên\s*[- ]?\s*huế|hue|thua\s*thien\s*hue", "thua_thien_hue", "Thua Thien Hue", "Central"),
    (r"tiền\s*giang|tien\s*giang", "tien_giang", "Tien Giang", "South"),
    (r"trà\s*vinh|tra\s*vinh", "tra_vinh", "Tra Vinh", "South"),
    (r"tuyên\s*quang|tuyen\s*quang", "tuyen_quang", "Tuyen Quang", "North"),
    (r"vĩnh\s*long|vinh\s*long", "vinh_long", "Vinh Long", "South"),
    (r"vĩnh\s*phúc|vinh\s*phuc", "vinh_phuc", "Vinh Phuc", "North"),
    (r"yên\s*bái|yen\s*bai", "yen_bai", "Yen Bai", "North"),
)

# ---- fixed values: reading a search request ------------------------------------------------
DEFAULT_RESPONSE_LIMIT = 5
MAX_RESPONSE_LIMIT = 10
SALARY_SCAN_LIMIT = 1000
SALARY_RETRIEVAL_LIMIT = 50
COUNT_PATTERNS = (
    r"\b(\d{1,2})\s*(?:job|jobs|viec|cong viec)\b",
    r"\b(?:top|lay|tim|cho toi|cho minh|goi y)\s*(\d{1,2})\b",
)
NUMBER_WORDS = (
    ("mot", 1),
    ("moot", 1),
    ("hai", 2),
    ("ba", 3),
    ("bon", 4),
    ("tu", 4),
    ("nam", 5),
    ("sau", 6),
    ("bay", 7),
    ("tam", 8),
    ("chin", 9),
    ("muoi", 10),
)
JOB_NOUNS = "job|jobs|viec|cong viec"
SALARY_TERMS = ("luong", "salary", "thu nhap", "income")
HIGH_TERMS = ("cao nhat", "highest", "top salary", "luong cao", "max salary")
FILLER_TERMS = (
    "job",
    "jobs",
    "viec",
    "cong viec",
    "cho toi",
    "cho minh",
    "tim",
    "kiem",
    "goi y",
    "top",
    "luong",
    "salary",
    "thu nhap",
    "income",
    "cao nhat",
    "highest",
    "cao",
    "max",
    "nhat",
    "co",
    "ra",
)

# ---- fixed values: retrieval records -------------------------------------------------------
METADATA_FIELDS = (
    "job_id",
    "source_platform",
    "url",
    "job_title",
    "company_name",
    "job_locations",
    "job_category",
    "work_model_normalized",
    "work_arrangement_normalized",
    "experiences_level",
    "year_of_experiences",
    "salary",
    "salary_min_million",
    "salary_max_million",
    "salary_avg_million",
    "salary_band",
    "job_posted_date",
    "job_posted_timestamp",
)
# result field -> metadata field
RESULT_FIELDS = {
    "title": "job_title",
    "company": "company_name",
    "source_platform": "source_platform",
    "url": "url",
    "locations": "job_locations",
    "category": "job_category",
    "work_model": "work_model_normalized",
    "work_arrangement": "work_arrangement_normalized",
    "experience_level": "experiences_level",
    "years_of_experience": "year_of_experiences",
    "salary": "salary",
    "salary_min_million": "salary_min_million",
    "salary_max_million": "salary_max_million",
    "salary_avg_million": "salary_avg_million",
    "salary_band": "salary_band",
    "posted_date": "job_posted_date",
}
# label -> column of the text that gets embedded
EMBEDDING_PARTS = (
    ("Job Title", "job_title"),
    ("Company", "company_name"),
    ("Source Platform", "source_platform"),
    ("Location", "job_locations"),
    ("Category", "job_category"),
    ("Experience Level", "experiences_level"),
    ("Years of Experience", "year_of_experiences"),
    ("Work Type", "work_arrangement_normalized"),
    ("Work Model", "work_model_normalized"),
    ("Education", "education_requirement"),
    ("Salary", "salary"),
    ("Salary Band", "salary_band"),
    ("Requirements", "requirements"),
    ("Description", "descriptions"),
    ("Tags", "tags"),
)
EMBED_BATCH = 100
CONTEXT_DOCUMENT_CHARS = 1200
MESSAGE_LIMIT = 1900
RESULT_LINES = 10

# ---- fixed values: web pages ---------------------------------------------------------------
CHALLENGE_SIGNS_A = (
    "just a moment",
    "attention required",
    "verify you are human",
    "cf-challenge",
    "cloudflare",
)
CHALLENGE_SIGNS_B = (
    "access denied",
    "captcha",
    "checking your browser",
    "just a moment",
    "verify you are human",
    "cloudflare",
)
TRACKING_SUFFIX_A = "?lab_feature="
TRACKING_SUFFIX_B = "?ta_source"
TOTAL_PAGES_PATTERN = r"/\s*([\d.]+)\s*trang"

# ---- fixed values: limits of checks, throttles and audit text ------------------------------
BATCH_ROWS = (1, 500)
SAMPLE_VALUES = 20
THROTTLE_REQUESTS = 10
THROTTLE_SECONDS = 60
ERROR_CHARS = 5_000
TRACE_CHARS = 10_000
HIDDEN_SALARY = "Sign-in for details."
