"""What a report of a problem should say about the installation.  The environment's variables stay out of it."""

from __future__ import annotations

import json
import platform
import sys
from importlib import metadata


def bundle() -> str:
    """JSON of the system, the Python and the installed packages."""
    packages = {d.metadata["Name"]: d.version for d in metadata.distributions() if d.metadata["Name"]}
    return json.dumps({"system": platform.platform(), "python": sys.version, "packages": dict(sorted(packages.items()))}, indent=1)


if __name__ == "__main__":
    print(bundle())
