"""Entry point of the streaming job for spark-submit; see ``--help``."""

from tickloom.__main__ import main

if __name__ == "__main__":
    main()
