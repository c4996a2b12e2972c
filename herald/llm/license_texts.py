"""Whole licence texts by SPDX identifier: the files under ``licenses``, and texts derived from them.

No own files are at hand for AGPL-3.0 and for the Creative Commons licences besides BY-SA 4.0 and CC0.
They differ from GPL-3.0 and BY-SA in titles and few paragraphs; those are put in here, which is
near enough to tell the whole texts apart by their nearest template.
"""

from __future__ import annotations

import re
from functools import cache
from importlib.resources import files

_REMOTE = ("Remote Network Interaction; Use with the GNU General Public License. Notwithstanding any other provision "
           "of this License, if you modify the Program, your modified version must prominently offer all users "
           "interacting with it remotely through a computer network (if your version supports such interaction) an "
           "opportunity to receive the Corresponding Source of your version by providing access to the "
           "Corresponding Source from a network server at no charge, through some standard or customary means of "
           "facilitating copying of software.")
_NONCOMMERCIAL = ("NonCommercial means not primarily intended for or directed towards commercial advantage or monetary "
                  "compensation. For purposes of this Public License, the exchange of the Licensed Material for "
                  "other material subject to Copyright and Similar Rights by digital file-sharing or similar means "
                  "is NonCommercial provided there is no payment of monetary compensation in connection with the "
                  "exchange. reproduce and Share the Licensed Material, in whole or in part, for NonCommercial "
                  "purposes only; and produce, reproduce, and Share Adapted Material for NonCommercial purposes "
                  "only. including when the Licensed Material is used other than for NonCommercial purposes. ")
_NO_DERIVATIVES = ("produce and reproduce, but not Share, Adapted Material. For the avoidance of doubt, You do not have "
                   "permission under this Public License to Share Adapted Material. ")


def _affero(gpl: str) -> str:
    flat = " ".join(gpl.split())
    flat = re.sub(r"(?i)\bGNU General Public License", "GNU Affero General Public License", flat)
    return re.sub(r"13\. Use with the GNU Affero .*?(?=14\. Revised)", lambda m: f"13. {_REMOTE} ", flat, flags=re.S)


def _creative_commons(by_sa: str, extra: str) -> str:
    parts = re.split(r"\n\s*\n", by_sa)
    if "ShareAlike" not in extra:
        start = next(i for i, p in enumerate(parts) if p.strip().startswith("b. ShareAlike"))
        end = next(i for i, p in enumerate(parts) if i > start and p.lstrip().startswith("Section 4"))
        parts = [p for p in parts[:start] + parts[end:] if "BY-SA" not in p]
    title = f"Attribution-{extra}" if extra else "Attribution"
    text = "\n\n".join(parts).replace("Attribution-ShareAlike", title)
    if "ShareAlike" not in extra:
        text = text.replace("Attribution and ShareAlike", "Attribution")
    return text + (_NONCOMMERCIAL if "NonCommercial" in extra else "") \
        + (_NO_DERIVATIVES if "NoDerivatives" in extra else "")


@cache
def full_texts() -> dict[str, str]:
    texts = {f.name.removesuffix(".txt"): f.read_text(encoding="utf-8")
             for f in files("herald.llm").joinpath("licenses").iterdir() if f.name.endswith(".txt")}
    by_sa = texts["CC-BY-SA-4.0"]
    texts["AGPL-3.0"] = _affero(texts["GPL-3.0"])
    for code, extra in (("BY", ""), ("BY-NC", "NonCommercial"), ("BY-ND", "NoDerivatives"),
                        ("BY-NC-SA", "NonCommercial-ShareAlike"), ("BY-NC-ND", "NonCommercial-NoDerivatives")):
        texts[f"CC-{code}-4.0"] = _creative_commons(by_sa, extra)
    return dict(sorted(texts.items()))
