from fernlight.cli import main

main()
