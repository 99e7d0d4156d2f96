"""``python -m tagweave``."""

from tagweave.cli import main

if __name__ == "__main__":
    main()
