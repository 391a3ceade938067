"""Extraction options (the reference's command-line switches), frozen."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Fixed values that must equal the reference's defaults.
# Tags whose open/close tags are dropped while their content is kept.
DEFAULT_IGNORED_TAGS = (
    "abbr", "b", "big", "blockquote", "center", "cite", "em",
    "font", "h1", "h2", "h3", "h4", "hiero", "i", "kbd",
    "p", "plaintext", "s", "span", "strike", "strong",
    "tt", "u", "var",
)
# Elements removed together with their content.
DEFAULT_DISCARD_ELEMENTS = (
    "gallery", "timeline", "noinclude", "pre",
    "table", "tr", "td", "th", "caption", "div",
    "form", "input", "select", "option", "textarea",
    "ul", "li", "ol", "dl", "dt", "dd", "menu", "dir",
    "ref", "references", "img", "imagemap", "source", "small",
    "sub", "sup", "indicator",
)
# Namespaces whose internal links keep their label.
DEFAULT_ACCEPTED_NAMESPACES = ("w", "wiktionary", "wikt")
# Template and module namespace keys.
TEMPLATE_NS_KEYS = (10, 828)
MAX_TEMPLATE_DEPTH = 30
MAX_PARAMETER_DEPTH = 10
DEFAULT_FILE_BYTES = 1024 * 1024


@dataclass(frozen=True)
class Options:
    """One immutable options object handed to every operator."""

    url_base: str = ""
    expand_templates: bool = True
    keep_links: bool = False
    keep_sections: bool = False
    keep_lists: bool = False
    to_html: bool = False
    write_json: bool = False
    print_revision: bool = False
    min_text_length: int = 0
    filter_disambig_pages: bool = False
    keep_tables: bool = False
    escape_doc: bool = False
    accepted_namespaces: tuple = DEFAULT_ACCEPTED_NAMESPACES
    ignored_tags: tuple = DEFAULT_IGNORED_TAGS
    discard_elements: tuple = DEFAULT_DISCARD_ELEMENTS
    template_prefix: str = "Template:"
    module_prefix: str = "Module:"
    file_bytes: int = DEFAULT_FILE_BYTES
    compress: bool = False
    # Round caps of the iterated expansion (calls, parameters).
    max_template_depth: int = MAX_TEMPLATE_DEPTH
    max_parameter_depth: int = MAX_PARAMETER_DEPTH
    # Run-time words (CURRENTYEAR...) are taken from this instant so runs repeat.
    run_ts: str = "2020-01-01 00:00:00"
    known_namespaces: tuple = field(default=(("Template", 10),))
    # If set, a page whose text grows past this many characters while it is expanded ends the job.
    max_page_chars: int | None = None
    # Q06 fix by option: normalize call and template titles before lookup.
    normalize_titles: bool = False
    # Keys with at least this many rows are split in joins (see operators.joins).
    hot_key_rows: int = 100_000
    # Q12 option: #ifexist looks its title up among the dump's pages (off: always the else branch).
    ifexist_titles: bool = False

    def with_(self, **kw) -> "Options":
        return replace(self, **kw)

    @property
    def ignore_tags_all(self) -> tuple:
        """Ignored tags plus ``a`` when links are not kept."""
        tags = tuple(self.ignored_tags)
        if not (self.keep_links or self.to_html):
            tags = tags + ("a",)
        return tags

    @property
    def links_kept(self) -> bool:
        return self.keep_links or self.to_html
