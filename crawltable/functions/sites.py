"""Site and scope arguments, worked out on the driver."""

import re
from collections.abc import Sequence


def normalize_host(site: str) -> str:
    """Lower-case host of a URL or bare name; port and user part are kept."""
    host = split_site(site)[0].strip().strip(".").lower()
    if not host:
        raise ValueError(f"no host in {site!r}")
    return host


def split_site(site: str) -> tuple[str, str]:
    """``(host, path)`` of a URL, or of a name given without a scheme."""
    site = site.strip()
    scheme = re.match(r"(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//", site)
    rest = site[scheme.end() :] if scheme else site
    parts = re.match(r"([^/?#]*)([^?#]*)", rest)
    return parts[1], parts[2]


def pattern_list(patterns: str | Sequence[str] | None) -> list[str]:
    if patterns is None:
        return []
    return [patterns] if isinstance(patterns, str) else list(patterns)


def scope_patterns(url: str, scope: str = "host") -> tuple[str, str]:
    """``(site, pattern)`` that keep a crawl within ``url``.

    ``host`` is the exact host, ``domain`` also its subdomains and siblings without
    ``www.``. A path becomes a prefix that ends at a slash. The pattern ends with
    ``\\z``, since ``$`` would also match before a final line end.
    """
    if scope not in ("host", "domain"):
        raise ValueError("scope must be 'host' or 'domain'")
    host, path = split_site(url)
    site = host.removeprefix("www.") if scope == "domain" else host
    if not site:
        raise ValueError(f"no host in {url!r}")
    subdomain = r"([^/]+\.)?" if scope == "domain" else ""
    prefix = re.escape(path.rstrip("/"))
    return site, rf"^https?://{subdomain}{re.escape(site)}{prefix}(/[^\n]*)?\z"
