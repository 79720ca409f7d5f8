"""States that results depend on, as plain text."""

BROKER_HOSTS = (
    "sedo.com sedoparking.com dan.com afternic.com hugedomains.com ibrandmaker.com dynadot.com efty.com undeveloped.com namebright.com "
    "parkingcrew.net bodis.com cashparking.com above.com tucows.com realnames.com forsale.com domainstore.com godaddy.com buydomains.com "
    "parklogic.com voodoo.com parked.com domainmarket.com epik.com snapnames.com domainagents.com names.co.uk banggood.com any-domains.uk"
).split()
SALE_MARKERS = [
    "domain for sale", "this domain may be for sale", "buy this domain", "domain is for sale", "domain name for sale", "available for sale",
    "domain parking", "domain is parked", "this domain is parked", "parked by", "parked free", "sedo.com", "afternic.com",
]
PARKING_MARKERS = [
    "domain for sale", "this domain may be for sale", "buy this domain", "domain is for sale", "domain name for sale", "godaddy auctions", "sedo.com", "afternic.com",
    "available for sale", "domain parking", "domain is parked", "this domain is parked", "this web page is parked", "parked by", "parked free", "domain has expired",
    "this domain has expired", "renew this domain",
]
REGISTRAR_WORDS = ["lander", "parking", "expired", "renew"]
JUNK_EMAILS = (
    "email@email.com email@email.co.uk email@mail.com admin@admin.com john@doe.com jane@doe.com abc@xyz.com abc@mail.com abc@gmail.com xyz@xyz.com xyz@abc.com "
    "xyz@gmail.com null@null.null your@email.com your@email.here name@company.com name@company.co.uk name@domain.com email@domain.com test@test.com test@mail.com "
    "test@fb.com test@whatsapp.com info@info.info"
).split()
JUNK_EMAIL_DOMAINS = (
    "example.com example.org example.net sample.com sample.org dummy.com invalid.com invalid.name mailinator.com yopmail.com yopmail.fr guerrillamail.com "
    "guerrillamail.de guerrillamail.net sharklasers.com grr.la mysite.com"
).split()
RETRY_MARKERS = ["timeout", "deadline exceeded", "eof", "connection reset", "connection refused", "temporary", "tls handshake", "remote error: tls", "tls:", "operation timed out"]
DOWNGRADE_MARKERS = ["tls", "connection refused", "connection reset", "eof", "server gave http response to https client"]
REDIRECT_STATUS = [301, 302, 303, 307, 308]
NAME_ERROR_MARKERS = ["no such host", "name resolution"]

#: Kind of page and the path fragments that point to it, in the order in which a crawl visits them.
PAGE_LINKS = {
    "about_page": "/about /about-us /who-we-are",
    "contact_page": "/contact /contact-us /get-in-touch /enquir /reach",
    "careers_page": "/career /jobs /work-with-us /join /employment /hiring /opportunit",
    "vacancies_page": "/vacanc /job-openings /current-jobs /apply /roles",
    "terms_page": "/terms /t-and-c /tcs /conditions",
    "privacy_page": "/privacy /data-protection /cookie",
    "legal_page": "/legal /company-information /registered-office /imprint",
}
ARCHIVE_SLUGS = "/post/ /blog/ /article/ /news/ /category/ /tag/ /archive/ /release/".split()
#: Kind of the page that a contact was found on: first fragment wins.
PAGE_KINDS = {
    "vacancies_page": "vacanc /job-opening /apply /role",
    "careers_page": "/career /jobs /join /work-with-us /employment /hiring",
    "contact_page": "/contact contact-us /get-in-touch /enquir /reach",
    "privacy_page": "/privacy",
    "terms_and_conditions_page": "/terms /t-and-c /tcs /conditions",
}
SOCIAL_DOMAINS = {
    "facebook": ["facebook.com"], "instagram": ["instagram.com"], "linkedin": ["linkedin.com"],
    "tiktok": ["tiktok.com"], "twitter": ["twitter.com", "x.com"], "youtube": ["youtube.com"],
}

PLATFORMS = "wordpress shopify webflow wix squarespace bigcommerce hubspot duda gohighlevel".split()
#: Platform, points, and markers of which one is enough.
PLATFORM_MARKERS = [
    ("wordpress", 6, ["wp-content", "wp-includes"]),
    ("wordpress", 5, ["wp-json", "rest_route", "api.w.org"]),
    ("wordpress", 5, ["wp-json/oembed", "oembed/1.0", "wp-embed.js"]),
    ("wordpress", 5, ["wp-emoji", "_wpemojisettings"]),
    ("wordpress", 4, ["admin-ajax.php", "ajaxurl"]),
    ("wordpress", 3, ["wp-block-", "wp-image-", "wp-post-image"]),
    ("wordpress", 3, ["wpapisettings", "wp_var", "wpdata", "wp.hooks", "wp.i18n"]),
    ("shopify", 7, ["cdn.shopify.com", "/cdn/shop", "/cdn/shopifycloud"]),
    ("shopify", 6, [".myshopify.com", "shopify.", "shopifyanalytics", "shopifypaymentbutton"]),
    ("shopify", 4, ["shopify-section-", "shopify-payment-button"]),
    ("webflow", 7, ["data-wf-site", "data-wf-page"]),
    ("webflow", 6, ["webflow.js", "webflow.css", "webflow.push"]),
    ("webflow", 4, ["w-webflow-badge", "w-nav", "w-slider", "w-dyn-list"]),
    ("wix", 7, ["static.parastorage.com", "wixstatic.com"]),
    ("wix", 7, ["wix-thunderbolt", "thunderbolt", "wixcodeapi", "wixbisession"]),
    ("wix", 5, ["_api/wix", "x-wix-request-id"]),
    ("squarespace", 7, ["static1.squarespace.com", "static.squarespace.com", "squarespace-cdn.com"]),
    ("squarespace", 5, ["squarespace_context", "squarespace-ui"]),
    ("bigcommerce", 7, ["bigcommerce.com/s-", "/images/stencil", "/stencil/assets"]),
    ("bigcommerce", 6, ["bcdata", "stencil-utils", "bigcommerce", "bc_channel_id"]),
    ("hubspot", 7, ["hs_cos_wrapper", "data-hs-cos-"]),
    ("hubspot", 6, ["hs-scripts.com", "hsforms.com", "hbspt.forms.create", "_hsq", "hs-analytics"]),
    ("gohighlevel", 7, ["sites.ludicrous.cloud"]),
    ("gohighlevel", 7, ["leadconnectorhq.com", "msgsndr.com", "gohighlevel.com", "highlevel.com"]),
    ("gohighlevel", 5, ["leadconnector", "data-leadconnector", "data-ghl"]),
]
#: Platform, points, and markers that are needed together.
PLATFORM_ALL_OF = [
    ("wordpress", 6, ["<meta", "generator", "wordpress"]),
]
#: Platform, points and a pattern (ASCII word borders are written out, since engines differ in theirs).
PLATFORM_PATTERNS = [
    ("duda", 7, r"(^|[\"'=(\t\n\f\r ])/(_dm|dmassets)([/?#]|\\u002f|$)"),
    ("duda", 7, r"(^|[^a-z0-9_])(window\.)?dmapi([^a-z0-9_]|$)"),
    ("duda", 6, r"(^|[^a-z0-9_])(dmcore|dmx|dmmobile|dmroot|duda(-site|-runtime)?)([^a-z0-9_]|$)"),
]
IDENTITY_STOP_WORDS = (
    "about apply career careers company contact current employment home hiring join jobs opportunities our people roles site team the vacancies website work with www "
    "ac au biz ca co com edu gov ie info io me net org uk us"
).split()
LEGAL_CONTEXT_WORDS = frozenset(
    "a an and are as at be being by but changes content correct date for from including in is it its law licensed not of on operated or our terms that the their this "
    "to was were which with written your".split()
)
BUSINESS_TYPES = frozenset("organization corporation localbusiness company ngo".split())
BLOCKED_BOARD_FRAGMENTS = ["careers.smartrecruiters.com/yellltd", "jobs.smartrecruiters.com/yellltd", "business.yell.com/features/yell-ads-and-jobs"]
#: Fixed patterns, without regard to case: a feed of jobs, and what pages of boards under a company's own host load (its font,
#: its company number at the provider, its site's assets).
CUSTOM_BOARD_PATTERNS = [
    r"<link\b[^>]+rel=[\"'][^\"']*alternate[^\"']*[\"'][^>]+type=[\"']application/rss\+xml[\"'][^>]+href=[\"'][^\"']*/jobs\.rss[\"']",
    r"fonts\.teamtailor-cdn\.com/teamtailor-production/[a-z0-9][a-z0-9-]*?(?:-\d+)?/custom-fonts\.css",
    r"https?://app\.teamtailor\.com/companies/([a-z0-9_-]+@[a-z0-9_-]+)(?:[/'?\s]|$)",
    r"assets(?:-[a-z0-9-]+)?\.teamtailor-cdn\.com/[^\"'<> ]*careersite-[^\"'<> ]+\.css|data-careersite--ready",
]
