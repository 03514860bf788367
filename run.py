"""spark-submit entry: ``spark-submit --py-files tallygrove.zip run.py train ...``."""

from tallygrove.cli import main

if __name__ == "__main__":
    main()
