"""Fixed values of the journey encoding and of the analysis definitions."""

# --- fixed values: delimiters and markers of the sequence text ---
HIT_DELIMITER = ">>"
FIELD_DELIMITER = "<<"
EVENT_DELIMITER = "<:<"
TAXON_DELIMITER = ","
LIST_DELIMITER = ","
NULL_TEXT = "NULL"
PAGE_HIT = "PAGE<:<NULL<:<NULL"
LEGACY_EVENT_DELIMITER = "//"
LEGACY_FIELD_DELIMITER = "::"

# --- fixed values: patterns removed before a sequence is split ---
ODD_FRAGMENTS = r">>iii\.+|>>\.+|\s>>>\s"
QUOTES = "[\"']"

# --- fixed values: custom dimension numbers ---
DIMENSION_DOCUMENT_TYPE = 2
DIMENSION_CONTENT_ID = 4
DIMENSION_TAXONS = 59
DIMENSION_AB_VARIANT = 65

# --- fixed values: content ids that stand for "no content" ---
PLACEHOLDER_CONTENT_IDS = [
    "00000000-0000-0000-0000-000000000000",
    "[object Object]",
]

# --- fixed values: document types of pages that help to find other pages ---
FINDING_DOCUMENT_TYPES = [
    "document_collection",
    "finder",
    "homepage",
    "license_finder",
    "mainstream_browse_page",
    "organisation",
    "search",
    "service_manual_homepage",
    "service_manual_topic",
    "services_and_information",
    "taxon",
    "topic",
    "topical_event",
]

# --- fixed values: event names ---
FEEDBACK_YES = "ffYesClick"
RELATED_CATEGORY = "relatedLinkClicked"
RELATED_ACTION = "Related content"
EXPLORE_ACTION = "Explore the topic"
BREADCRUMB_CATEGORY = "breadcrumbClicked"
HOME_LINK_CATEGORY = "homeLinkClicked"
NAVIGATION_CATEGORIES = [
    "breadcrumbClicked",
    "homeLinkClicked",
    "/search",
    "navDocumentCollectionLinkClicked",
    "navAccordionLinkClicked",
    "navLeafLinkClicked",
    "navPolicyAreaLinkClicked",
    "navServicesInformationLinkClicked",
    "navSubtopicContentItemLinkClicked",
    "navSubtopicLinkClicked",
    "navTopicLinkClicked",
    "relatedTaxonomyLinkClicked",
    "stepNavHeaderClicked",
    "stepNavLinkClicked",
    "stepNavPartOfClicked",
]
NAVIGATION_PAIRS = [(RELATED_CATEGORY, EXPLORE_ACTION)]
SEARCH_QUERY = "/search?q="

# --- fixed values: final page types, the last matching pattern decides ---
FINAL_PAGE_TYPES = [
    ("/government/publications/", "government_publication"),
    ("log-in", "login"),
    ("sign-in", "login"),
    ("login", "login"),
    ("check", "check"),
    ("apply", "apply"),
    ("contact", "contact/enquiries"),
    ("enquiries", "contact/enquiries"),
    ("get-.*-information.*", "get_information"),
    ("send", "send"),
    ("find", "find"),
    ("calculat", "calculate/calculator"),
    ("order", "order"),
    ("manage", "manage"),
    ("update", "update"),
    ("eligibility", "eligibility"),
    ("estimate", "estimate"),
    ("renew", "renew"),
    ("pay", "pay"),
    ("claim", "claim"),
    ("change", "change"),
]

EXIT_PAGE = "/exit"

# The columns that count something per journey.
COUNTABLE = (
    "Languages",
    "Locations",
    "DeviceCategories",
    "TrafficSources",
    "TrafficMediums",
    "NetworkLocations",
    "Dates",
)
