from meterwise.cli import main

main()
